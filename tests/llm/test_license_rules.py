"""License rules on texts that hold nothing else, against all rules without keywords or gates."""

import re
from re import _constants as ops
from re import _parser

import pytest

from gleanspark.llm import licenses


def needs(node, word):
    """Whether every match of a parsed regex holds the word, in one run of literals."""
    run = ""
    for op, arg in node:
        if op is ops.SUBPATTERN:
            op, arg = (ops.BRANCH, (None, [arg[3]]))
        if op is ops.LITERAL:
            run += chr(arg)
            if word in run:
                return True
            continue
        run = ""
        if op is ops.BRANCH and all(needs(a, word) for a in arg[1]) or op is ops.MAX_REPEAT and arg[0] > 0 and needs(arg[2], word):
            return True
    return False


def example(node, space):
    """A text that a parsed regex matches: the first alternatives, nothing optional, and the given space between words of a name."""
    out = ""
    for op, arg in node:
        if op is ops.LITERAL:
            out += chr(arg)
        elif op is ops.SUBPATTERN:
            out += example(arg[3], space)
        elif op is ops.BRANCH:
            out += example(arg[1][0], space)
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
            out += example(arg[2], space) * arg[0]
        elif op is ops.IN:
            first = arg[0]
            out += (space if len(arg) > 1 else "\n") if first == (ops.CATEGORY, ops.CATEGORY_SPACE) else "0" if first[0] is ops.CATEGORY else chr(first[1])
    return out


def expected(text):
    """Labels and number of detections by all rules, the base phrases aside."""
    low = text.lower()
    found = sorted((m.start(), -m.end(), -p, label) for label, _, rx, p in licenses.rules() for m in re.finditer(rx, low))
    kept = [d for i, d in enumerate(found) if not any(-e[1] >= -d[1] and -e[2] >= -d[2] for e in found[:i])]
    return {d[3] for d in kept}, len(kept)


def same(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.report(rows).collect()}
    for i, text in enumerate(texts):
        labels = set(filter(None, got[i]["labels"].split(","))) - set(filter(None, got[i]["base_labels"].split(",")))
        assert (labels, got[i]["n_detections"]) == expected(text), text
        assert labels, text
    return got


def test_every_match_holds_its_keyword():
    assert [(label, keyword, rx) for label, keyword, rx, _ in licenses.rules() if not needs(_parser.parse(rx), keyword)] == []


GATED = [
    "GNU General\nPublic License version 2", "MIT-No-Attribution License", "GNU Lesser\nGeneral Public License", "Expat License", "Berkeley License",
    "Copyright 2020, all rights\nreserved", "Copyright 2020, in the public\n  domain", "Creative\nCommons Attribution 4.0 license", "copyright of x, © 2020",
]


def test_wrapped_and_hyphenated_notices(spark):
    got = same(spark, GATED)
    assert [got[i]["labels"] for i in (0, 1, 2)] == ["GPL-2.0,gpl", "MIT-0", "LGPL,gpl"]


def test_every_rule_holds_a_gate():
    assert [(label, rx) for label, _, rx, _ in licenses.rules() if not any(needs(_parser.parse(rx), g) for g in licenses.GATES)] == []


UNGATED = [
    "released under cc0 1.0 universal", "see http://mozilla.org/MPL", "https://www.eclipse.org/legal/epl-v10", "http://www.gnu.org/copyleft/gpl", "https://creativecommons.org/publicdomain/zero/1.0",
    "http://scripts.sil.org/OFL", "http://www.wtfpl.net", "https://mariadb.com/bsl11", "\u00a9 2020", "in the public\ndomain", "all rights\nreserved", "Creative\nCommons Attribution",
]


@pytest.mark.parametrize("space", ["\n", "-"])
def test_each_rule_alone(spark, space):
    texts = [example(_parser.parse(rx), space) for _, _, rx, _ in licenses.rules()]
    assert all(re.fullmatch(rx, text) for (_, _, rx, _), text in zip(licenses.rules(), texts, strict=True))
    got = same(spark, texts + UNGATED)
    assert all(r["score"] > 0 for r in got.values())
