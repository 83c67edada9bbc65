import os
import random
from pathlib import Path

import pyarrow as pa
import pytest
from brute import exact, near, near_links
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, near_dedup, shingles
from tidemark.llm.components import components, merged

ROWS = [(3, "a  b"), (1, "a\tb"), (2, "A b"), (2, "A b"), (7, None), (8, ""), (None, ""), (None, "lone"), (9, "x " * 30000), (5, "a b "), (6, "é b")]
SCHEMA = "doc_id long, text string, dig string, body string, source string, sig int, n int, lang string, n_chars long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "d", "b", None, 1, 2, None, None) for i, t in rows], SCHEMA).repartition(parts)


def key(r):
    return tuple((v is not None, v) for v in r)


@pytest.mark.parametrize("digest", [exact_dedup.content_digest, lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1))])
def test_exact_groups(spark, digest):
    got = [tuple(r) for r in exact_dedup.exact_groups(frame(spark, ROWS), digest=digest).collect()]
    assert sorted(got, key=key) == sorted(exact(ROWS), key=key)


def test_hot_groups_are_salted(spark):
    rows = [(i, "same" if i % 2 else f"t{i % 50}") for i in range(4000)]
    got = [tuple(r) for r in exact_dedup.exact_groups(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(exact(rows))


def test_drop_copies_keeps_whole_rows_once(spark):
    kept = exact_dedup.drop_copies(frame(spark, ROWS))
    assert kept.columns == frame(spark, ROWS).columns
    wanted = {(i, h) for i, _, _, k, h in exact(ROWS) if k}
    assert kept.count() == len(wanted)
    assert exact_dedup.drop_copies(frame(spark, [])).count() == 0 and exact_dedup.exact_groups(frame(spark, [])).count() == 0


NEAR = [(i, " ".join(f"w{(i // 4) * 7 + k}" for k in range(40)) + (" extra" * (i % 4))) for i in range(60)] + ROWS + [(70, "One two"), (71, "one TWO"), (72, "two one"), (73, " \n")]


@pytest.mark.parametrize("hot_cell", [near_dedup.HOT_CELL, 2])
def test_near_groups(spark, hot_cell):
    got = [tuple(r)[:3] for r in near_dedup.near_groups(frame(spark, NEAR), hot_cell).collect()]
    assert sorted(got, key=key) == sorted(near(NEAR), key=key)


def test_near_groups_of_families_without_a_common_leader(spark):
    """Chains and halves that stars alone would leave apart."""
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[:40] + [f"x{i // 3}-{k}" for k in range(6 * (i // 3))] + [f"y{i}"])) for i in range(24)]
    got = [tuple(r)[:3] for r in near_dedup.near_groups(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(near(rows))


@pytest.mark.parametrize("block", [near_dedup.BLOCK_SETS, 7])
def test_links_of_families(spark, monkeypatch, block):
    """Near copies with one or two edited words, of several sizes: every link counts, whichever groups its sets are in."""
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", block)
    rnd, rows = random.Random(3), []
    for family, copies in enumerate([2, 5, 12, 30]):
        base = [f"f{family}w{rnd.randrange(5000)}" for _ in range(220)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.randint(1, 4)):
                text[rnd.randrange(len(text))] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rows += [(500 + i, " ".join(f"c{k}" for k in range(4 * i, 4 * i + 60))) for i in range(12)] + [(700, rows[0][1]), (700, rows[0][1]), *ROWS]
    got = [(r["doc_id"], r["n_links"]) for r in near_dedup.near_groups(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(near_links(rows), key=key)


def edited(family, copies, least, most, words, rnd):
    """Near copies of one text, which itself is not among them."""
    base = [f"f{family}w{rnd.randrange(5000)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rnd.randint(least, most)):
            text[rnd.randrange(len(text))] = f"e{rnd.randrange(10**6)}"
        yield " ".join(text)


def test_sketches_allow_every_link_of_a_block():
    """Sketch words with the highest bit set are negative numbers; their bits count like all others."""
    rnd = random.Random(8)
    sets = shingles.shingle_sets([t for family in range(6) for t in edited(family, 12, 2, 5, 60 + 90 * family, rnd)])
    number = list(range(len(sets)))
    wide = [shingles.parity_bits(s, shingles.wide_bits(len(s))) for s in sets]
    assert any(w < 0 for x in wide for w in x)
    table = pa.table({"sig": number, "n": [len(s) for s in sets], "component": number, "wide": pa.array(wide, pa.list_(pa.int64())), "job": [1] * len(sets), "side": [2] * len(sets)})
    plain = [set(s.tolist()) for s in sets]
    links = {(i, j) for j in number for i in range(j) if 100 * len(plain[i] & plain[j]) >= 75 * len(plain[i] | plain[j])}
    for closest in (True, False):  # each set is a component of its own, so the closest are all
        found = near_dedup._sketch_pairs(table, closest)
        assert len(links) > 100 and links <= set(zip(found["a"].to_pylist(), found["b"].to_pylist(), strict=True))


def test_keep_one_and_empty(spark):
    kept = near_dedup.keep_one(frame(spark, NEAR[:60]))
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({c for _, _, c in near(NEAR[:60])})
    assert near_dedup.near_groups(frame(spark, [])).count() == 0


def test_sketch_distance_is_a_lower_bound():
    a, b = shingles.shingle_sets([" ".join(map(str, range(90))), " ".join(map(str, range(4, 99)))])
    apart = len(set(a.tolist()) ^ set(b.tolist()))
    bits = shingles.wide_bits(len(a))
    assert sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(shingles.parity_bits(a, bits), shingles.parity_bits(b, bits), strict=True)) <= apart


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(100, 3), (100, 25)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert all(got[n] == (0 if n < 10 or 20 <= n < 30 or n == 100 else n // 10 * 10) for n in got) and len(got) == 41


def plain_components(edges):
    least = {}

    def find(x):
        least.setdefault(x, x)
        while least[x] != x:
            x = least[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            least[max(a, b)] = min(a, b)
    return {x: find(x) for x in least}


def test_components_with_a_hub_and_later_edges(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(900), rnd.randrange(900)) for _ in range(300)] + [(5, rnd.randrange(900)) for _ in range(200)] + [(i, i + 1) for i in range(850, 890)]
    later = [(rnd.randrange(960), rnd.randrange(960)) for _ in range(60)]
    first = components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, first.collect())) == sorted(plain_components(edges).items())
    assert sorted(map(tuple, merged(first, spark.createDataFrame(later, "u long, v long")).collect())) == sorted(plain_components(edges + later).items())


def test_mix_edges(spark):
    rows = [(1, "a b c", "s1"), (2, None, "s1"), (3, "d", None), (None, "e f", "s2"), (5, "", "s3"), (5, "g h i j", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    plan = mixing.mixture_plan(df.drop("size")).collect()
    assert len(plan) == 6 and all(r["copies"] <= 2 for r in plan)
    assert abs(sum({r["source"]: r["target"] for r in plan}.values()) - 15.0) < 1e-9
    mixed = mixing.emit_copies(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mixture_plan(df.limit(0)).count() == 0


def test_taken_words_are_as_near_their_targets_as_single_draws_allow(spark):
    """A source's taken words depart from its target by the spread of its documents' draws, and no further."""
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(1, 300), f"s{i % 7}" if i % 3 else "s0") for i in range(3000)]
    plan = mixing.mixture_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in {r["source"] for r in plan}:
        mine = [r for r in plan if r["source"] == source]
        share = mine[0]["rate"] % 1
        spread = (share * (1 - share) * sum(r["size"] ** 2 for r in mine)) ** 0.5
        taken = sum(r["size"] * r["copies"] for r in mine)
        assert abs(taken - mine[0]["target"]) <= 4 * spread + 1e-6 and abs(taken - mine[0]["target"]) < 0.1 * mine[0]["target"]
        assert all(int(mine[0]["rate"]) <= r["copies"] <= int(mine[0]["rate"]) + 1 for r in mine)


def test_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
    if not sf.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    for query, sql in ((exact_dedup.op6_exact_dedup, exact_dedup.OP6_SQL), (mixing.op10_mix_sources, mixing.OP10_SQL)):
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(map(tuple, query(spark, str(sf)).select(*names).collect())) == sorted(want.fetchall())
