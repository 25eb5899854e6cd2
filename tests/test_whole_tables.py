"""Queries over whole tables against brute force on small ones."""

import collections
import random

from pyspark.sql import functions as F

from noticeweave.operators import matching
from noticeweave.plans.catalog import QUERIES


def roots(rows):
    """{member: smallest member reachable over shared keys} for (member, key)."""
    root = {m: m for m, _ in rows if m is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    first = {}
    for m, k in rows:
        if m is not None and k is not None:
            a, b = find(m), find(first.setdefault(k, m))
            root[max(a, b)] = min(a, b)
    return {m: find(m) for m in root}


def test_components_by_order_use_every_row_of_lineitem(spark, tmp_path):
    draw = random.Random(3)
    rows = [(draw.randrange(120), draw.randrange(200), 1 + draw.randrange(7), float(draw.randrange(1, 51))) for _ in range(230)] + [(500, 900, 3, 40.0), (501, 900, 4, 30.0), (502, None, 1, 1.0)]
    spark.createDataFrame(rows, "l_partkey long, l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["components_by_order"](spark, str(tmp_path)).collect()
    expected = roots([r[:2] for r in rows])
    assert {r["doc"]: r["root"] for r in found} == expected and len(found) == len(expected)
    assert expected[501] == 500 and expected[502] == 502 and len(set(expected.values())) > 5


def test_components_by_line_use_every_line(spark, tmp_path):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, "\n".join(draw.choice(words) for _ in range(draw.randrange(1, 6)))) for i in range(150)]
    rows += [(200, "A  common Line\n\nx1"), (201, " a common line "), (202, "\t\n \n"), (203, ""), (204, None), (201, "x2"), (205, "X2\n")] + [(300 + i, f"only {i}\na COMMON line") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["components_by_line"](spark, str(tmp_path)).collect()
    expected = roots([(i, " ".join(x.lower().split()) or None) for i, t in rows for x in (t or "").split("\n")])
    assert {r["doc"]: r["root"] for r in found} == expected and len(found) == len(expected)
    assert expected[339] == expected[205] == 200 and expected[202] == 202 and len(set(expected.values())) > 5


def test_variant_key_match_all_uses_every_part(spark, tmp_path):
    draw = random.Random(5)
    rows = [(i, f"{draw.choice(['small', 'red', 'large', 'hot'])} {draw.choice(['ring', 'red', 'bolt'])}", f"Brand#{draw.randrange(3)}", draw.randrange(1, 51)) for i in range(60)]
    rows += [(100, None, "Brand#1", 1), (101, "", "Brand#2", 2), (102, "red", "Brand#1", 9), (103, "small ring", None, 3)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    keys = lambda name, i: {name, (name.split(" ") + [""])[i], name[:6]} - {""} if name else set()
    expected = collections.Counter()
    for a, x, m, _ in rows:
        for b, y, n, _ in rows:
            if m and n and m != n and (both := keys(x, 0) & keys(y, 1)):
                expected[a, b, min(both)] += 1
    found = QUERIES["variant_key_match_all"](spark, str(tmp_path))
    assert found.columns == ["p_partkey", "other", "key"]
    assert collections.Counter(tuple(r) for r in found.collect()) == expected and len(expected) > 300


def variant_pairs(rows, sized):
    """{(p_partkey, other, key): rows} of parts (p_partkey, p_name, p_brand, p_size) by comparing all with all."""
    keys = lambda name, size, i: {k + (f"|{size}" if sized else "") for k in {name, (name.split(" ") + [""])[i], name[:6]} - {""}} if name else set()
    return collections.Counter((a, b, min(both)) for a, x, m, s in rows for b, y, n, t in rows if m and n and m != n and (both := keys(x, s, 0) & keys(y, t, 1)))


def made_before_last_exchange(df):
    """Whether a row a pair goes through a shuffle: no lists are exploded above the last exchange."""
    return "Generate explode" not in df._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]


def test_variant_key_match_all_makes_pairs_behind_the_last_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 7, raising=False)
    draw = random.Random(6)
    rows = [(i, draw.choice(["large ring"] * 9 + ["ring large", "large", "hot red", "red hot", None, ""]), f"Brand#{draw.randrange(4)}", draw.randrange(3)) for i in range(150)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = QUERIES["variant_key_match_all"](spark, str(tmp_path))
    assert not made_before_last_exchange(found)
    expected = variant_pairs(rows, False)
    assert collections.Counter(tuple(r) for r in found.collect()) == expected and len(expected) > 5000


def test_variant_join_of_ids_on_several_rows(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 3, raising=False)
    draw = random.Random(7)
    make = lambda: [(draw.randrange(30), [draw.choice(["a", "b", "c", "d", "", None]) for _ in range(draw.randrange(4))]) for _ in range(60)] + [(None, ["a"]), (31, None)]
    left, right = make(), make()
    expected = {}
    for x, ks in left:
        for y, ls in right:
            for k in {*(ks or [])} & {*(ls or [])} - {"", None}:
                expected[x, y] = min(k, expected.get((x, y), k))
    found = matching.variant_join(spark.createDataFrame(left, "x long, k array<string>"), spark.createDataFrame(right, "y long, k array<string>"), "x", "y", F.col("k"), F.col("k"))
    assert found.columns == ["x", "y", "key"] and sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((*pair, k)) for pair, k in expected.items())


def test_variant_key_match_makes_pairs_behind_the_last_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 5, raising=False)
    draw = random.Random(8)
    rows = [(i, draw.choice(["small ring", "small bolt", "ring small", "small", "hot red"]), draw.choice(["Brand#1", "Brand#2", None]), draw.choice([1, 2, 11, None])) for i in range(200)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = QUERIES["variant_key_match"](spark, str(tmp_path))
    assert not made_before_last_exchange(found)
    expected = variant_pairs([r for r in rows if r[3] is not None], True)
    assert collections.Counter(tuple(r) for r in found.collect()) == expected and len(expected) > 500


def test_summary_by_entity_adds_in_the_order_of_rows(spark, tmp_path):
    draw = random.Random(9)
    rows = [(i, i % 40, draw.choice([1e16, -1e16, 1.0, 0.5, 3.25, 2.5, None]), draw.choice(["1-URGENT", "5-LOW", "2-HIGH"])) for i in range(1200)]
    rows += [(2000, 50, 0.5, "5-LOW"), (2001, 50, 2.0, "5-LOW"), (2002, 51, None, "5-LOW"), (2003, None, 1.5, "2-HIGH")]
    df = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string")
    df.repartition(7).write.parquet(f"{tmp_path}/orders.parquet")
    expected = {}
    for _, k, price, priority in rows:
        total, keys = expected.get(k, (None, set()))
        expected[k] = (total if price is None else (total or 0.0) + price, keys | {priority})
    found = {r.o_custkey: (r.total, r["keys"]) for r in QUERIES["summary_by_entity"](spark, str(tmp_path)).collect()}
    assert found == {k: (None if total is None else str(int(round(total))), ";".join(sorted(keys))) for k, (total, keys) in expected.items()}
