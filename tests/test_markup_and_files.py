"""Markup with missing and surplus end tags, texts of any script, and files read in blocks."""

import csv
import io
import random
import time
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from noticeweave.functions import text, unicode
from noticeweave.plans.catalog import ORACLES, QUERIES
from noticeweave.plans.texts import ODD
from noticeweave.sources import files, tags

FOLDER = "/root/testdata/sf0.001"


def test_page_text():
    page = "<html><head><title>T &eacute;&#233;&#xe9; &notanentity;</title><style>p{}</style></head><body><nav>menu<p>more</nav><p>a<b>b</b> c<p>d<br>e</span><!-- no --><script>x<y</script><footer>f"
    assert tags.visible_text(page) == "T ééé ¬anentity; a b c d e"
    assert tags.visible_text("<p>abcdef</p>", 3) == "abc [truncated]" and tags.visible_text("<p>abc</p>", 3) == "abc"
    assert [tags.visible_text(x) for x in (None, "", "no tags &amp; all", "</div></p>x", "<li", "a<3 b", "a<!--x-->b")] == ["", "", "no tags & all", "x", "<li", "a<3 b", "a b"]


def test_list_items():
    item = '<li><h2><a href="/{0}">t{0}</a></h2><dl><dt>Soort<dd>k{0}<dt>NR</dt><dd>{0}</dl>'
    page = item.format(1) + '<div id="X"><p><ul>' + item.format(2) + item.format(3) + '<ul><li><a class="a result--subtitle" href="s">&eacute; <b>4</b></a></ul>' + item.format(5) + '</li></ul><ol>' + item.format(6) + "</ol></div><ul>" + item.format(7) + "</ul>"
    found = tags.list_items(page, "X", ["soort", "nr", "none"])
    assert [(i["title"], i["href"], i["terms"]) for i in found] == [("t2", "/2", ["k2", "2", ""]), ("é4", "s", ["k3", "3", ""]), ("é4", "s", ["", "", ""]), ("t5", "/5", ["k5", "5", ""])]
    assert tags.list_items(page, "Y", []) == tags.list_items(None, "X", []) == []


def test_deep_and_long_pages_take_no_longer():
    began = time.perf_counter()
    assert tags.visible_text("<div>x" * 100_000).count("x") == 100_000
    assert tags.visible_text("<ul><li>x" * 50_000).count("x") == 50_000
    assert len(tags.visible_text("<p>" + "wort " * 400_000)) == 1_999_999
    assert time.perf_counter() - began < 30


def test_page_text_column(spark):
    rows = [("<p>&eacute;</p>", 1), (None, 2), ("x" * 50, 3)]
    df = spark.createDataFrame(rows, "html string, position int")
    assert [r[0] for r in df.orderBy("position").select(tags.page_text("html", 40)).collect()] == ["é", "", "x" * 40 + " [truncated]"]


def test_fold_all(spark):
    odd = ["ﬁn", "x²", "½", "한국", "é", "ÅÄ", " Één\t", "ß", "İ", "Ω", "", None, "ǆ", "ṩ", "ạ̇", "日本", "ÿŸ", "\x1ca"]
    odd += ["".join(chr(random.Random(i).choice([random.Random(i * 7).randint(32, 0x24F), random.Random(i * 5).randint(0x300, 0xD7FF)])) for _ in range(1)) + "x" for i in range(300)]
    wanted = ["".join(c for c in unicodedata.normalize("NFKD", (v or "").strip().lower()) if not unicodedata.combining(c)) for v in odd]
    df = spark.createDataFrame(list(enumerate(odd)), "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(unicode.fold_all("v")).collect()] == wanted


@pytest.mark.parametrize("block", ["100b", "3k", "128m"])
def test_lines_of_one_file_in_many_blocks(spark, tmp_path, block):
    made = random.Random(3)
    rows = [[str(i), made.choice(["a", 'q"q', "two\nlines", 'x;"\n\n"y', "", "é" * 40]), str(i * 2)] for i in range(400)]
    out = io.StringIO()
    csv.writer(out, delimiter=";", quoting=csv.QUOTE_MINIMAL, lineterminator="\n").writerows(rows)
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text("".join(f"junk {i}\n" for i in range(5)) + out.getvalue())
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        plain = files.file_lines(spark, str(tmp_path))
        if block == "100b":
            assert plain.select(F.spark_partition_id()).distinct().count() > 1
        lines = (tmp_path / "one.csv").read_text().split("\n")[:-1]
        assert sorted((r.line_no, r.value) for r in plain.where("file LIKE '%one.csv'").collect()) == list(enumerate(lines, 1))
        found = files.headless_csv(spark, str(tmp_path), ["id", "note", "twice"], 5)
        assert sorted((int(r.id), r.note, r.twice) for r in found.collect()) == sorted((int(a), b, c) for a, b, c in rows + rows)
        first = {r.line_no for r in found.where("id = '0'").collect()}
        assert first == {6}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_heads_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("L,M,L\nkey,x,y\n1,2,3\n\n4,\"5\n5\",6\n")
    (tmp_path / "b.csv").write_text("M,Q\nz,key\n7,8\n")
    (tmp_path / "empty.csv").write_text("")
    found = files.multi_header_csv(spark, str(tmp_path), 1, {"k": "key", "l": "L", "m": "M"})
    assert sorted((r.line_no, r.k, r.l, r.m) for r in found.collect()) == [(3, "1", "3", "2"), (3, "8", "", "7"), (5, "4", "6", "5\n5")]


def test_evidence_and_context_on_all_documents(spark):
    import re

    def sentence(t):
        found = re.search(r"\bthe\b", t, re.I)
        if not found:
            return ""
        begin = max(t.rfind(s, 0, found.start()) for s in ".;:") + 1
        end = min((k for k in (t.find(s, found.end()) for s in ".;:") if k >= 0), default=len(t) - 1) + 1
        return t[begin:end].strip(" ")

    def context(t):
        found = re.search(r"\bthe\b", t, re.I)
        if not found:
            return ""
        before, after = t[: found.start()], t[found.end() :]
        left = before.split()[-6:] if before and not before[-1].isspace() else before.split()[-5:]
        words = after.split()
        right = words[:6] if after and not after[0].isspace() else words[:5]
        glue = ("" if not before or not before[-1].isspace() else " "), ("" if not after or not after[0].isspace() else " ")
        return " ".join((" ".join(left) + glue[0] + found[0] + glue[1] + " ".join(right)).split())

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["evidence_and_context"](spark, FOLDER).collect():
        assert r.sentence == sentence(texts[r.doc_id]), r.doc_id
        assert r.context == context(texts[r.doc_id]), r.doc_id


def test_placed_counts_by_ranges(spark):
    from noticeweave.operators import records

    rows = [(i, random.Random(i).choice([None, 1, 2, 3])) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = records.placed(spark.createDataFrame(rows, "i int, k int"), -F.col("k"), F.col("i"))
        found = sorted((r.place, r.i) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted = [i for i, _ in sorted(rows, key=lambda r: (-(r[1] or 9), r[0]))]
    assert found == list(enumerate(wanted, 1))


def test_file_name_has_no_query(spark):
    assert spark.range(1).select(text.file_name(F.lit("https://x/y/%C3%A9%zz+a.pdf?b=c/d.pdf"))).first()[0] == "zz_a.pdf"


def test_folded_texts_keep_what_the_sql_keeps_at_their_ends(spark, tmp_path):
    texts = ["", " ", "\n", "\n a\n", "\t", "a\t\n", "é\n ", "\u00a0a\u3000", "|", "|a|\n|", "É", "\u2003\u00a0ß\t"]
    rows = [(i, t) for i, t in enumerate(x for x in texts for _ in ODD)] + [(999, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = [tuple(r) for r in QUERIES["folded_texts"](spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert found == duck.execute(f"{ORACLES['folded_texts']} ORDER BY doc_id").fetchall() and len(found) == len(texts) * len(ODD)
    assert found[0][1] == " fi2" and found[23][1] == "\n a\n"


def test_fold_all_at_ends_that_only_python_strips(spark):
    odd = ["a\u2028", "a \x85", "\u2029", "\x85a\x1f", " \na\r\n", "a\u2028\n", "é\u2028"]
    df = spark.createDataFrame(list(enumerate(odd)), "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(unicode.fold_all("v")).collect()] == [unicode.folded(v) for v in odd]
