"""A sheet's bad records: kept, with reasons, counted in the pass that writes them."""

from pyspark.sql import functions as F

from supplyscope.session import scratch_path
from supplyscope.sources import checked as C

HEADER = ",".join(C.SHEET_SCHEMA.names)


def split(spark, lines, **kw):
    path = scratch_path(spark, "sheet")
    spark.createDataFrame([(x,) for x in [HEADER, *lines]], "value string").coalesce(1).write.text(path)
    return C.split_sheet(spark, path, scratch_path(spark, "split"), **kw)


def line(seq, ip="10.0.0.1", level="50%", stamp="2024-01-01 00:00:00", kit=""):
    return f"{seq},n,{ip},M,{level},,,,{kit},,OK,{stamp}"


def test_reasons_and_counts(spark):
    s = split(spark, [line(1), line(2, level="--"), line(3, level="full"), line(4, stamp="soon"), line(5, ip=" "),
                      line(6, ip="", level="x", stamp="", kit="1e"), "7,n", line(8) + ",more", ""])
    assert [r.seq for r in s.clean.orderBy("seq").collect()] == ["1", "2"]
    assert s.clean.columns == C.SHEET_SCHEMA.names
    got = {r.seq: r.reasons for r in s.rejected.filter(F.col(C.LINE).isNull()).collect()}
    assert got == {"3": "toner_negro: no percentage", "4": "marca_de_tiempo: no time", "5": "ip: blank",
                   "6": "ip: blank; toner_negro: no percentage; kit_mant: no percentage; marca_de_tiempo: no time"}
    broken = s.rejected.filter(F.col(C.LINE).isNotNull()).collect()
    assert sorted(r[C.LINE] for r in broken) == ["7,n", line(8) + ",more"] and {r.reasons for r in broken} == {"no record"}
    assert (s.read, s.broken, s.bad_cells, s.kept) == (8, 2, 4, 2)


def test_every_line_is_in_one_output(spark):
    s = split(spark, [line(i, level=str(i) if i % 3 else "?") for i in range(300)] + ["x"] * 7)
    assert s.clean.count() + s.rejected.count() == s.read == 307 and s.clean.count() == s.kept == 200


def test_a_sheet_of_another_layout_is_rejected_visibly(spark):
    s = split(spark, ["a;b;c", "1;2;3"])
    assert s.kept == 0 and s.broken == 2 and sorted(r[C.LINE] for r in s.rejected.collect()) == ["1;2;3", "a;b;c"]


def test_empty_sheet(spark):
    s = split(spark, [])
    assert s.read == s.kept == 0 and s.clean.collect() == [] and s.rejected.collect() == []


def test_clean_rows_go_on_as_a_log(spark):
    from supplyscope.operators.history import clean_history

    s = split(spark, [line(1), line(2, level="bad"), line(3, stamp="2024-01-02 00:00:00")])
    log = s.clean.withColumn("seq", F.col("seq").cast("long"))
    assert sorted((r.seq, r.toner_negro) for r in clean_history(log).collect()) == [(1, 50.0), (3, 50.0)]
