"""Every registered query of the engine's own operators against its SQL; of those without SQL, only that they run (the near-duplicate fold has a plain version in test_synthesis)."""

import duckdb
import pytest

from gleanspark import registry
from gleanspark.functions import text as t
from gleanspark.operators import selection
from gleanspark.operators.scoring import Config

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, db, name):
    got = registry.queries()[name](spark, SF)
    rows = got.collect()
    if name not in registry.oracle_sql():
        assert rows or name.startswith(("exp_sel", "win_select"))
        return
    want = db.sql(registry.oracle_sql()[name])
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    found = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=str)
    at = [want.columns.index(c) for c in order]
    assert found == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


def test_representatives_are_capped():
    config = Config(max_representatives=2)
    seen = selection.Representatives(config)
    texts = ["alpha beta gamma delta one", "totally different words here now", "yet another thing altogether fine", "alpha beta gamma delta one"]
    assert [seen.check(x) for x in texts] == ["", "", "saturated", ""]
    assert seen.check("alpha beta gamma delta one!") in ("near", "saturated")


def test_simhash_counts_ties_as_set():
    a, b = t.weights(["x"], {}), t.weights(["y"], {})
    assert t.weights(["x", "y"], {}) & ((1 << 64) - 1) == (a | b) & ((1 << 64) - 1)
    assert t.weights([], {}) == 0
