"""Sources, sinks and the scoring stream."""

import os
import tempfile
import time

import pytest

from lexgrid.plans import models
from lexgrid.plans.catalog import SENTIMENT_PREFIX
from lexgrid.sources import files as IO
from lexgrid.streaming.scoring import scoring_plan, start_score_stream


def test_csv_quotes_newlines_and_bad_label(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    path = os.path.join(d, "train.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('text,label\n"a ""q"", b\nline2",1\nplain,abc\n')
    df = IO.read_labelled_csv(spark, path, "text string, label int")
    rows = df.collect()
    assert rows[0].text == 'a "q", b\nline2' and rows[0].label == 1
    assert rows[1].label is None and rows[1]._corrupt_record is not None


def test_csv_by_header_name(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), "t.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("label,text\n1,a\n")
    assert [tuple(r)[:2] for r in IO.read_labelled_csv(spark, path, "text string, label int").collect()] == [("a", 1)]
    with pytest.raises(ValueError, match="no column score"):
        IO.read_labelled_csv(spark, path, "text string, score int")


def test_csv_keeps_white_space_and_splits_have_own_schemas(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    rows = [(1, "  a \n", 0), (2, "", 1), (3, None, None), (4, '"q" ', 2), (5, "\t,x", 1), (6, "\\", 0)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    IO.write_csv(df, os.path.join(d, "train"))
    IO.write_csv(df.select("id", "text"), os.path.join(d, "test"))
    both = IO.read_splits(spark, {"train": os.path.join(d, "train"), "test": os.path.join(d, "test")},
                          {"train": "id int, text string, label int", "test": "id int, text string"}).collect()
    assert sorted((r.id, r.text, r.label) for r in both if r.split == "train") == rows
    assert sorted((r.id, r.text, r.label) for r in both if r.split == "test") == [(i, t, None) for i, t, _ in rows]


def test_stream_equals_batch(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    d = tempfile.mkdtemp(prefix="stream-")
    q = start_score_stream(spark, f"{small_dir}/documents*.parquet", docs.schema, "doc_id", "text",
                           SENTIMENT_PREFIX, models.length_logits, models.SENTIMENT_LABELS,
                           os.path.join(d, "sink"), os.path.join(d, "ckpt"))
    q.awaitTermination()
    streamed = spark.read.parquet(os.path.join(d, "sink"))
    batch = scoring_plan(docs, "doc_id", "text", SENTIMENT_PREFIX, models.length_logits,
                         models.SENTIMENT_LABELS)
    assert streamed.count() == docs.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_workbooks_from_files(spark):
    import zipfile
    from lexgrid.sources import workbook as WB
    d = tempfile.mkdtemp(prefix="xlsx-")
    WB.write_workbook_file(os.path.join(d, "a.xlsx"), ["id", "shop_name", "brand_id"],
                           [["1", "Tea <&> Co", "9999285772"], ["2", "NA", None]])
    # a second workbook in the shared-strings form, with a number cell and a blank cell
    sheet = ('<?xml version="1.0" encoding="UTF-8"?>'
             '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c>'
             '<c r="C1" t="s"><v>2</v></c></row>'
             '<row r="2"><c r="A2"><v>3</v></c><c r="C2"><v>99998888500391</v></c></row>'
             '</sheetData></worksheet>')
    sst = ('<?xml version="1.0" encoding="UTF-8"?>'
           '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
           '<si><t>id</t></si><si><t>shop_name</t></si><si><r><t>brand</t></r><r><t>_id</t></r></si></sst>')
    with zipfile.ZipFile(os.path.join(d, "b.xlsx"), "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", sst)
    df = WB.read_workbooks(spark, d, ["id", "shop_name", "brand_id", "brand_name"], optional=["brand_name"])
    got = sorted((r.id, r.shop_name, r.brand_id, r.brand_name) for r in df.collect())
    assert got == [("1", "Tea <&> Co", "9999285772", None), ("2", None, None, None),
                   ("3", None, "99998888500391", None)]
    with pytest.raises(Exception, match="no column brand_name"):
        WB.read_workbooks(spark, d, ["id", "brand_name"]).collect()
    named = WB.read_workbooks(spark, d, ["key"], aliases={"id": "key"})
    assert sorted(r.key for r in named.collect()) == ["1", "2", "3"]


def test_workbook_source_writes_and_reads(spark, tmp_path):
    from lexgrid.sources import workbook as WB
    WB.register_workbooks(spark)
    rows = [(str(i), f"name <{i}> & co", None if i % 3 else "", "NA") for i in range(250)]
    df = spark.createDataFrame(rows, "id string, a string, b string, c string").repartition(3)
    path = str(tmp_path / "books")
    df.write.format("workbook").mode("append").option("maxRows", 40).save(path)
    files = sorted(os.listdir(path))
    assert len([f for f in files if f.endswith(".xlsx")]) >= 7
    back = spark.read.format("workbook").schema("c string, id string, a string, b string").load(path)
    want = sorted((i, a, None, c) for i, a, _, c in rows)
    assert sorted((r.id, r.a, r.b, r.c) for r in back.collect()) == want
    assert back.rdd.getNumPartitions() == len([f for f in files if f.endswith(".xlsx")])
    # the same files by Spark's own file reader
    assert sorted((r.id, r.a, r.b, r.c) for r in WB.read_workbooks(spark, path, ["id", "a", "b", "c"], na_tokens=None).collect()) == want
    named = spark.read.format("workbook").schema("key string, more string").options(aliases='{"id": "key"}', optional='["more"]').load(path)
    assert sorted(r.key for r in named.collect()) == sorted(r[0] for r in rows)
    with pytest.raises(Exception, match="no column nope"):
        spark.read.format("workbook").schema("nope string").load(path).collect()
    df.where("id < '2'").write.format("workbook").mode("overwrite").save(path)
    again = spark.read.format("workbook").schema("id string").load(path)
    assert again.count() == sum(r[0] < "2" for r in rows)


def test_failed_workbook_write_leaves_nothing(spark, tmp_path):
    from pyspark.sql import functions as F
    from lexgrid.sources import workbook as WB
    WB.register_workbooks(spark)
    path = str(tmp_path / "books")
    bad = spark.range(100).repartition(2).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("string").alias("id"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("workbook").mode("append").save(path)
    left = [f for _, _, names in os.walk(path) for f in names]
    assert left == []


def test_workbook_rows_stream_out(tmp_path):
    from lexgrid.sources import workbook as WB
    path = str(tmp_path / "big.xlsx")
    WB.write_workbook_file(path, ["a", "b"], ([str(i), None] for i in range(3000)))
    with open(path, "rb") as f:
        rows = WB.picked_rows(f, path, ["b", "a"])
        assert next(rows) == [None, "0"] and sum(1 for _ in rows) == 2999


def test_rejects_are_routed_and_counted(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = [(i, None if i % 4 == 0 else "t", None if i % 6 == 0 else i) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    counts = IO.route_rejects(df, {"no label": F.col("label").isNull(), "no text": F.col("text").isNull(), "never": F.col("id") < 0}, str(tmp_path / "r"))
    assert counts == {"ok": 40, "no label": 10, "no text": 10, "never": 0}
    assert sorted(r.id for r in IO.accepted(spark, str(tmp_path / "r")).collect()) == [i for i in range(60) if i % 4 and i % 6]
    assert {(r.id, r.reason) for r in IO.rejected(spark, str(tmp_path / "r")).collect()} == {
        (i, "no label" if i % 6 == 0 else "no text") for i in range(60) if i % 4 == 0 or i % 6 == 0}


def test_keyed_stream_recovers(spark, tmp_path):
    from pyspark.errors import StreamingQueryException
    from lexgrid.streaming.scoring import Progress, read_keyed, start_keyed_stream
    source, sink, state = (str(tmp_path / x) for x in ("source", "sink", "state"))
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(source)
    progress = Progress()
    spark.streams.addListener(progress)

    def start(after=None):
        return start_keyed_stream(spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source), sink, state, after)

    def fail(batch_id):
        if batch_id == 1:
            raise RuntimeError("between write and commit")

    with pytest.raises(StreamingQueryException):
        start(fail).awaitTermination()
    assert read_keyed(spark, sink).count() == 20        # the second batch is written, not committed
    start().awaitTermination()
    spark.range(30, 35).coalesce(1).write.mode("append").parquet(source)
    start().awaitTermination()
    wait = time.time() + 20                             # progress comes on a thread of its own
    while sum(n for _, _, n in progress.batches) < 35 and time.time() < wait:
        time.sleep(0.2)
    spark.streams.removeListener(progress)
    assert sorted(r.id for r in read_keyed(spark, sink).collect()) == list(range(35))
    assert sum(n for _, _, n in progress.batches) >= 35 and progress.failures == 1


def test_brand_counts_merge(spark):
    from lexgrid.operators.resolve import BrandCounts
    counts = BrandCounts(spark)
    for run in range(3):
        counts.add(str(run), spark.range(run * 2000, run * 2000 + 4000).selectExpr("concat('b', id) AS b", "id % 2 AS tier"), "b", "tier")
    got = {r.tier: (r.runs, r.rows, r.brands) for r in counts.merged().collect()}
    for tier, exact in ((0, 4000), (1, 4000), (None, 8000)):
        runs, rows, brands = got[tier]
        assert runs == 3 and rows == (6000 if tier is not None else 12000)
        assert abs(brands - exact) <= 4 * BrandCounts.ERROR * exact
