"""License scans by ordered signature rules, in built-in expressions only.

A rule is a regex over the lower-cased text with a keyword, a label and a priority. Families of licenses (name
pattern, keyword, SPDX label, site) are written by hand; each gives a rule per template: SPDX tag,
notice, link, name with version, name. A text without a gate word is done at once; else only rules whose keyword it contains
are matched. Work grows with the text's length and, but for a root, with the number of matches. Detections are ordered by start, longest first; one that lies within an earlier detection of the same or a
higher priority is suppressed.

Besides, base phrases are found as consecutive words (letters, digits and anything beyond ASCII). Null text counts as empty: no words, empty labels,
score 0. Repeated rows and ids give a row each. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import ascii_lower

#: A word: letters, digits, anything beyond ASCII.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases, as words, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: No rule matches a text without one of these: each rule's regex holds one in a run of literals (links: "http").
GATES = ("licen", "http", "copyright", "©", "domain", "reserved", "creative", "attribution", "cc0")

#: label, keyword, name pattern, link pattern. Names are matched in lower-cased text; "_" stands for white space or a hyphen.
#: Every match of the name holds the keyword, which is within one word, as words may be parted by a line break or a hyphen.
FAMILIES = (
    ("MIT", "licen", r"(?:mit|expat)_licen[cs]e", r"opensource\.org/licenses?/mit"),
    ("MIT-0", "attribution", r"mit_no_attribution(?:_licen[cs]e)?", r"opensource\.org/licenses?/mit-0"),
    ("X11", "x11", r"x11_licen[cs]e", r"spdx\.org/licenses/x11"),
    ("Apache-1.1", "apache", r"apache_(?:software_)?licen[cs]e,?_(?:version_)?v?1\.1", r"apache\.org/licenses/license-1\.1"),
    ("Apache-2.0", "apache", r"apache_(?:software_)?licen[cs]e,?_(?:version_)?v?2(?:\.0)?", r"apache\.org/licenses/license-2\.0"),
    ("Apache", "apache", r"apache_(?:software_)?licen[cs]e", r"apache\.org/licenses"),
    ("GPL-1.0", "general", r"(?:gnu_)?general_public_licen[cs]e,?_(?:version_|v)1(?:\.0)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("GPL-2.0", "general", r"(?:gnu_)?general_public_licen[cs]e,?_(?:version_|v)2(?:\.0)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("GPL-3.0", "general", r"(?:gnu_)?general_public_licen[cs]e,?_(?:version_|v)3(?:\.0)?", r"gnu\.org/licenses/gpl-3\.0"),
    ("GPL", "general", r"(?:gnu_)?general_public_licen[cs]e", r"gnu\.org/licenses/gpl(?:\.html|\.txt)?"),
    ("GPL-short", "gpl", r"(?:gnu_)?gpl(?:_?v?[123](?:\.0)?)?_licen[cs]e", r"gnu\.org/copyleft/gpl"),
    ("LGPL-2.0", "library", r"(?:gnu_)?library_general_public_licen[cs]e", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0"),
    ("LGPL-2.1", "lesser", r"(?:gnu_)?lesser_general_public_licen[cs]e,?_(?:version_|v)2\.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("LGPL-3.0", "lesser", r"(?:gnu_)?lesser_general_public_licen[cs]e,?_(?:version_|v)3(?:\.0)?", r"gnu\.org/licenses/lgpl-3\.0"),
    ("LGPL", "lesser", r"(?:gnu_)?lesser_general_public_licen[cs]e", r"gnu\.org/licenses/lgpl(?:\.html|\.txt)?"),
    ("AGPL-3.0", "affero", r"(?:gnu_)?affero_general_public_licen[cs]e(?:,?_(?:version_|v)3(?:\.0)?)?", r"gnu\.org/licenses/agpl(?:-3\.0)?"),
    ("GFDL", "documentation", r"(?:gnu_)?free_documentation_licen[cs]e", r"gnu\.org/licenses/(?:old-licenses/)?fdl"),
    ("BSD-2-Clause", "bsd", r"(?:bsd_2_clause|2_clause_bsd|simplified_bsd|freebsd)_licen[cs]e", r"opensource\.org/licenses?/bsd-2-clause"),
    ("BSD-3-Clause", "bsd", r"(?:bsd_3_clause|3_clause_bsd|new_bsd|modified_bsd|revised_bsd)_licen[cs]e", r"opensource\.org/licenses?/bsd-3-clause"),
    ("BSD-4-Clause", "bsd", r"(?:bsd_4_clause|4_clause_bsd|original_bsd)_licen[cs]e", r"spdx\.org/licenses/bsd-4-clause"),
    ("0BSD", "bsd", r"(?:zero_clause_bsd|0bsd|bsd_zero_clause)_licen[cs]e", r"opensource\.org/licenses?/0bsd"),
    ("BSD", "licen", r"(?:berkeley_|bsd_style_|bsd_)licen[cs]e", r"opensource\.org/licenses?/bsd-license"),
    ("MPL-1.1", "mozilla", r"mozilla_public_licen[cs]e,?_(?:version_|v)?1\.1", r"mozilla\.org/mpl/1\.1"),
    ("MPL-2.0", "mozilla", r"mozilla_public_licen[cs]e,?_(?:version_|v)?2(?:\.0)?", r"mozilla\.org/mpl/2\.0"),
    ("MPL", "mozilla", r"mozilla_public_licen[cs]e", r"mozilla\.org/mpl"),
    ("EPL-1.0", "eclipse", r"eclipse_public_licen[cs]e(?:_-)?,?_(?:version_|v)?1(?:\.0)?", r"eclipse\.org/legal/epl-v10"),
    ("EPL-2.0", "eclipse", r"eclipse_public_licen[cs]e(?:_-)?,?_(?:version_|v)?2(?:\.0)?", r"eclipse\.org/legal/epl-2\.0"),
    ("EPL", "eclipse", r"eclipse_public_licen[cs]e", r"eclipse\.org/legal/epl"),
    ("EDL-1.0", "eclipse", r"eclipse_distribution_licen[cs]e", r"eclipse\.org/org/documents/edl-v10"),
    ("CDDL-1.0", "development", r"common_development_and_distribution_licen[cs]e", r"opensource\.org/licenses?/cddl-1\.0"),
    ("CPL-1.0", "common", r"common_public_licen[cs]e", r"opensource\.org/licenses?/cpl1?\.0"),
    ("CPAL-1.0", "attribution", r"common_public_attribution_licen[cs]e", r"opensource\.org/licenses?/cpal"),
    ("EUPL-1.2", "european", r"european_union_public_licen[cs]e", r"opensource\.org/licenses?/eupl"),
    ("OSL-3.0", "software", r"open_software_licen[cs]e", r"opensource\.org/licenses?/osl-3\.0"),
    ("AFL-3.0", "academic", r"academic_free_licen[cs]e", r"opensource\.org/licenses?/afl-3\.0"),
    ("Artistic-1.0", "artistic", r"artistic_licen[cs]e,?_(?:version_|v)?1(?:\.0)?", r"opensource\.org/licenses?/artistic-1\.0"),
    ("Artistic-2.0", "artistic", r"artistic_licen[cs]e,?_(?:version_|v)?2(?:\.0)?", r"opensource\.org/licenses?/artistic-2\.0"),
    ("Artistic", "artistic", r"artistic_licen[cs]e", r"dev\.perl\.org/licenses"),
    ("ISC", "isc", r"isc_licen[cs]e", r"opensource\.org/licenses?/isc"),
    ("Zlib", "zlib", r"zlib(?:/libpng)?_licen[cs]e", r"zlib\.net/zlib_license"),
    ("libpng-2.0", "libpng", r"libpng_licen[cs]e", r"libpng\.org/pub/png/src/libpng-license"),
    ("BSL-1.0", "boost", r"boost_software_licen[cs]e", r"boost\.org/license_1_0"),
    ("BUSL-1.1", "business", r"business_source_licen[cs]e", r"mariadb\.com/bsl11"),
    ("SSPL-1.0", "server", r"server_side_public_licen[cs]e", r"mongodb\.com/licensing/server-side-public-license"),
    ("Elastic-2.0", "elastic", r"elastic_licen[cs]e(?:_2\.0)?", r"elastic\.co/licensing/elastic-license"),
    ("Unlicense", "unlicense", r"(?:the_)?unlicense", r"unlicense\.org"),
    ("WTFPL", "what", r"do_what_the_f\S+_you_want_to_public_licen[cs]e", r"wtfpl\.net"),
    ("CC0-1.0", "cc0", r"cc0(?:_1\.0)?(?:_universal)?", r"creativecommons\.org/publicdomain/zero"),
    ("CC-BY-3.0", "creative", r"creative_commons_attribution_3\.0", r"creativecommons\.org/licenses/by/3\.0"),
    ("CC-BY-4.0", "creative", r"creative_commons_attribution_4\.0", r"creativecommons\.org/licenses/by/4\.0"),
    ("CC-BY-SA", "creative", r"creative_commons_attribution_share_?alike", r"creativecommons\.org/licenses/by-sa"),
    ("CC-BY-NC", "creative", r"creative_commons_attribution_non_?commercial", r"creativecommons\.org/licenses/by-nc"),
    ("CC-BY-ND", "creative", r"creative_commons_attribution_no_?derivatives", r"creativecommons\.org/licenses/by-nd"),
    ("CC-BY", "creative", r"creative_commons_attribution", r"creativecommons\.org/licenses/by/"),
    ("ODbL-1.0", "database", r"open_database_licen[cs]e", r"opendatacommons\.org/licenses/odbl"),
    ("ODC-By-1.0", "commons", r"open_data_commons_attribution_licen[cs]e", r"opendatacommons\.org/licenses/by"),
    ("PDDL-1.0", "dedication", r"public_domain_dedication_and_licen[cs]e", r"opendatacommons\.org/licenses/pddl"),
    ("OFL-1.1", "font", r"(?:sil_)?open_font_licen[cs]e", r"scripts\.sil\.org/ofl"),
    ("PSF-2.0", "python", r"python_software_foundation_licen[cs]e", r"docs\.python\.org/3/license"),
    ("PHP-3.01", "php", r"php_licen[cs]e", r"php\.net/license"),
    ("Ruby", "ruby", r"ruby_licen[cs]e", r"ruby-lang\.org/en/about/license"),
    ("PostgreSQL", "postgresql", r"postgresql_licen[cs]e", r"postgresql\.org/about/licen[cs]e"),
    ("OpenSSL", "openssl", r"openssl_licen[cs]e", r"openssl\.org/source/license"),
    ("curl", "curl", r"curl_licen[cs]e", r"curl\.se/docs/copyright"),
    ("NCSA", "ncsa", r"(?:university_of_illinois/)?ncsa_open_source_licen[cs]e", r"opensource\.org/licenses?/ncsa"),
    ("MS-PL", "microsoft", r"microsoft_public_licen[cs]e", r"opensource\.org/licenses?/ms-pl"),
    ("MS-RL", "microsoft", r"microsoft_reciprocal_licen[cs]e", r"opensource\.org/licenses?/ms-rl"),
    ("CECILL-2.1", "cecill", r"cecill(?:_free_software)?_licen[cs]e", r"cecill\.info/licences"),
    ("Beerware", "beer", r"beer_?ware_licen[cs]e", r"spdx\.org/licenses/beerware"),
    ("JSON", "json", r"json_licen[cs]e", r"json\.org/license"),
    ("UPL-1.0", "permissive", r"universal_permissive_licen[cs]e", r"opensource\.org/licenses?/upl"),
    ("MulanPSL-2.0", "mulan", r"mulan_permissive_software_licen[cs]e", r"license\.coscl\.org\.cn/mulanpsl2"),
)
#: Rules of their own: label, keyword, regex, priority.
OTHERS = (
    ("all-rights-reserved", "reserved", r"\ball\s+rights\s+reserved\b", 30),
    ("public-domain", "domain", r"\b(?:placed\s+in|in|dedicated\s+to)\s+the\s+public\s+domain\b", 40),
    ("copyright", "copyright", r"\bcopyright\s+(?:\(c\)|©)?\s*(?:19|20)\d\d\b", 20),
    ("copyright", "©", r"©\s*(?:19|20)\d\d\b", 20),
    ("proprietary", "proprietary", r"\bproprietary\s+licen[cs]e\b", 50),
)
#: Priorities of the templates; a detection's confidence is its priority in hundredths.
TAG, NOTICE, LINK, NAME = 100, 90, 80, 60


def rules() -> list[tuple[str, str, str, int]]:
    """(label, keyword, regex, priority) of all rules, in order."""
    out = []
    for label, keyword, name, link in FAMILIES:
        pattern = name.replace("_", r"[\s-]+")
        tag = label.lower().replace(".", r"\.")
        out.append((label, "spdx", rf"spdx-licen[cs]e-identifier:\s*{tag}(?![\w.])", TAG))
        out.append((label, keyword, rf"\b(?:licen[cs]ed|released|distributed|available|provided|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+the\s+)?{pattern}(?![\w])", NOTICE))
        out.append((label, "http", rf"https?://(?:www\.)?{link}", LINK))
        out.append((label, keyword, rf"(?<![\w]){pattern}(?![\w])", NAME))
    return out + list(OTHERS)


def _detections(text: str) -> Column:
    """Detections (s, e, p, label) of all rules whose keyword the text has, unordered."""
    # as one SQL literal: a call a value from Python took ten times as long as the rest of planning
    table = F.expr("array(" + ",".join(f"named_struct('label', '{a}', 'kw', '{b}', 'rx', r'{c}', 'p', {d})" for a, b, c, d in rules()) + ")")
    found = F.transform(
        F.filter(table, lambda r: F.contains(F.col(text), r["kw"])),
        lambda r: F.struct(r["label"].alias("label"), r["p"].alias("p"), F.call_function("regexp_extract_all", F.col(text), r["rx"], F.lit(0)).alias("m"), r["rx"].alias("rx")),
    )
    found = F.filter(found, lambda r: F.size(r["m"]) > 0)
    # a match starts where the text before it ends: gap and match lengths are added up, in runs of about the root of their number, as an array that
    # grows by one is copied each time
    sized = F.transform(
        found,
        lambda r: F.struct(
            r["label"].alias("label"), r["p"].alias("p"), F.transform(r["m"], lambda m: F.length(m)).alias("own"),
            F.transform(F.call_function("split", F.col(text), r["rx"], F.lit(-1)), lambda g: F.length(g)).alias("gap"), F.ceil(F.sqrt(F.size(r["m"]))).cast("int").alias("run"),
        ),
    )
    runs = lambda r: F.sequence(F.lit(0), F.ceil(F.size(r["own"]) / r["run"]).cast("int") - 1)
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    sums = lambda r: F.transform(runs(r), lambda k: total(F.slice(r["own"], k * r["run"] + 1, r["run"])) + total(F.slice(r["gap"], k * r["run"] + 1, r["run"])))
    summed = F.transform(sized, lambda r: F.struct(r["label"].alias("label"), r["p"].alias("p"), r["own"].alias("own"), r["gap"].alias("gap"), r["run"].alias("run"), sums(r).alias("sums")))

    def based(r: Column) -> Column:
        """Where each run starts."""
        step = lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(r["sums"], F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")), step, lambda acc: acc["out"])

    placed = F.transform(summed, lambda r: F.struct(r["label"].alias("label"), r["p"].alias("p"), r["own"].alias("own"), r["gap"].alias("gap"), r["run"].alias("run"), based(r).alias("base")))
    empty = "cast(array() as array<struct<s:int,e:int,p:int,label:string>>)"

    def places(r: Column, k: Column) -> Column:
        """The detections of run k."""

        def step(acc: Column, i: Column) -> Column:
            s = acc["at"] + F.get(r["gap"], i)
            e = s + F.get(r["own"], i)
            return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), r["p"].alias("p"), r["label"].alias("label")))).alias("out"))

        own = F.sequence(k * r["run"], F.least((k + 1) * r["run"], F.size(r["own"])) - 1)
        return F.aggregate(own, F.struct(F.get(r["base"], k).alias("at"), F.expr(empty).alias("out")), step, lambda acc: acc["out"])

    return F.flatten(F.flatten(F.transform(placed, lambda r: F.transform(F.sequence(F.lit(0), F.size(r["base"]) - 1), lambda k: places(r, k)))))


def _kept(detections: Column) -> Column:
    """(labels, best priority, number) of the detections that no earlier one of the same or a higher priority contains."""
    levels = sorted({r[3] for r in rules()})
    ordered = F.sort_array(F.transform(detections, lambda d: F.struct(d["s"].alias("s"), (-d["e"]).alias("ne"), (-d["p"]).alias("np"), d["label"].alias("label"))))
    start = F.struct(*[F.lit(-1).alias(f"end{p}") for p in levels], F.expr("cast(array() as array<string>)").alias("labels"), F.lit(0).alias("best"), F.lit(0).alias("n"))

    def step(acc: Column, d: Column) -> Column:
        end, p = -d["ne"], -d["np"]
        within = F.lit(False)
        for level in levels:
            within = within | ((F.lit(level) >= p) & (acc[f"end{level}"] >= end))
        ends = [F.when(p == level, F.greatest(acc[f"end{level}"], end)).otherwise(acc[f"end{level}"]).alias(f"end{level}") for level in levels]
        labels = F.when(within | F.array_contains(acc["labels"], d["label"]), acc["labels"]).otherwise(F.concat(acc["labels"], F.array(d["label"])))
        return F.struct(*ends, labels.alias("labels"), F.when(within, acc["best"]).otherwise(F.greatest(acc["best"], p)).alias("best"), (acc["n"] + F.when(within, 0).otherwise(1)).alias("n"))

    return F.aggregate(ordered, start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["best"].alias("best"), acc["n"].alias("n")))


def scan(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, base_places (array of start and label), detections (labels, best, n) of every document."""
    low = docs.select(F.col(doc_id).alias("__id"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("__low"))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(F.col("__low"), F.lit(word))
    gated = low.select("__id", F.regexp_count("__low", F.lit(TOKEN)).cast("long").alias("n_words"), F.when(gate, F.col("__low")).alias("__text"))
    words = F.when(F.contains("__text", F.lit("license")), F.call_function("regexp_extract_all", F.col("__text"), F.lit(TOKEN), F.lit(0)))
    found = gated.select("__id", "n_words", "__text", words.alias("__words"))

    def label_at(i: Column) -> Column:
        """The label of the phrase that starts at word i, or null."""
        out = F.lit(None).cast("string")
        for phrase, label in BASE:
            hit = F.lit(True)
            for k, word in enumerate(phrase.split()):
                hit = hit & (F.get("__words", i + k) == word)
            out = F.when(hit, label).otherwise(out)
        return out

    starts = F.transform(F.sequence(F.lit(0), F.size("__words") - 1), lambda i: F.struct(i.cast("long").alias("start"), label_at(i).alias("label")))
    places = F.when(F.size("__words") > 0, F.filter(starts, lambda x: x["label"].isNotNull()))
    detections = F.when(F.col("__text").isNotNull(), _kept(_detections("__text")))
    return found.select(F.col("__id").alias(doc_id), "n_words", places.alias("base_places"), detections.alias("detections"))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and n_detections of every document."""
    found = scan(docs, doc_id=doc_id, text=text)
    none = F.expr("cast(array() as array<string>)")
    base = F.coalesce(F.array_sort(F.array_distinct(F.transform("base_places", lambda x: x["label"]))), none)
    own = F.coalesce(F.col("detections.labels"), none)
    n_base = F.coalesce(F.size("base_places"), F.lit(0))
    score = F.greatest(F.coalesce(F.col("detections.best") / 100, F.lit(0.0)), F.when(F.size(base) > 0, 0.5).otherwise(0.0))
    starts = F.transform("base_places", lambda x: x["start"])
    return found.select(
        doc_id,
        "n_words",
        F.when(n_base > 0, n_base).otherwise(0).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, own)), ",").alias("labels"),
        score.alias("score"),
        F.coalesce(F.col("detections.n"), F.lit(0)).alias("n_detections"),
    )
