import gzip
import hashlib
import io
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinderlane.functions import scalars
from cinderlane.operators import aggs, audit, joins, sampling, splits
from cinderlane.plans import queries
from cinderlane.sources import tables
from cinderlane.streaming import incremental


def test_reasons_and_classes(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    a = df.withColumn("r", audit.reasons({"negative": F.col("v") < 0, "missing": F.col("v").isNull()})).withColumn("c", audit.classify(F.col("r"), ["missing"]))
    assert {r.id: (r.r, r.c) for r in a.collect()} == {1: ([], "confirmed"), 2: (["missing"], "uncertain"), 3: (["negative"], "rejected")}
    with pytest.raises(ValueError, match="negative"):
        audit.split_good(df, {"negative": F.col("v") < 0}, strict=True)


def test_reconcile_and_parity(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, None), (4, "w")], "k int, v string")
    assert {r.k: r.status for r in joins.reconcile(a, b, ["k"], ["v"]).collect()} == {1: "only_left", 2: "differs", 3: "same", 4: "only_right"}
    assert sorted((r.k, r.field) for r in joins.parity(a, b, ["k"], ["v"]).collect()) == [(1, "v"), (2, "v"), (4, "v")]


def test_lineage(spark):
    df = spark.createDataFrame([(i, i - 1 if i else None) for i in range(40)], "n long, p long")
    assert {(r.root, r.node - r.depth) for r in joins.lineage(df, "n", "p").collect()} == {(0, 0)}


def test_values_in_bands_of_very_different_widths(spark):
    bands = [(i, i * 10.0, i * 10.0 + 7) for i in range(200)] + [(500, -1e6, 1e6), (501, 3.0, 3.25), (502, 5.0, 5.0), (503, None, 9.0), (504, -20.0, -10.0)]
    rows = [(i, v) for i, v in enumerate([0.0, 6.999, 7.0, 3.1, -15.0, -10.0, 1999.0, 1e6, -1e6, None, 5e6, 3.1])]
    for some in (bands, bands[:200], []):
        got = joins.lookup_interval(spark.createDataFrame(rows, "id int, v double"), "v", spark.createDataFrame(some, "band int, lo double, hi double")).select("id", "band").collect()
        want = [(i, b) for i, v in rows for b in ([k for k, lo, hi in some if v is not None and lo is not None and lo <= v < hi] or [None])]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_credit_goes_up_chains_of_any_length(spark):
    rows = [(i, i - 1 if i else None, i == 0) for i in range(300)] + [(1000, 1001, False), (1001, 1000, False), (2000, 5555, False), (3000, None, False), (4000, 299, True), (5000, 1000, None)]
    got = {r.node: r.credited for r in joins.credited(spark.createDataFrame(rows, "n int, p int, ok boolean"), "n", "p", "ok").collect()}
    assert got == {**{i: 0 for i in range(300)}, 1000: None, 1001: None, 2000: None, 3000: None, 4000: 4000, 5000: None}


def test_components_and_splits(spark):
    edges = spark.createDataFrame([(f"b{i}", f"k{i // 5}") for i in range(60)], "a string, b string")
    found = splits.components(edges, "a", "b")
    sizes = found.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(r.n for r in sizes.collect()) == [6] * 12
    filled = splits.weighted_fill(sizes, "root", "n", [("test", 0.25), ("train", 0.75)], "s")
    assert splits.leaks(found.join(filled, "root"), "node", "split").isEmpty()
    assert {r.split for r in filled.collect()} == {"test", "train"}


def test_components_split_uses_every_line(spark, tmp_path):
    orders = [(i, i) for i in range(1, 61)] + [(61, 1), (62, 62)]
    lines = [(i, 100 + i // 6, 2, 1.0) for i in range(1, 61)] + [(61, 900, 1, 50.0), (62, 901, 1, 1.0), (62, 105, 7, 3.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    sets = []
    for a, b in [(f"c{c}", f"o{o}") for o, c in orders] + [(f"s{x[1]}", f"o{x[0]}") for x in lines]:
        met = [x for x in sets if a in x or b in x]
        sets = [x for x in sets if x not in met] + [{a, b}.union(*met)]
    got = queries.components_split(spark, str(tmp_path)).collect()
    assert {r.root: r.n for r in got} == {min(x): len(x) for x in sets} and len(got) == len(sets) == 11


def test_weighted_fill_against_one_running_sum(spark):
    groups = [(f"k{i}", i % 7 + 1) for i in range(3000)] + [(None, 5)]
    frame = spark.createDataFrame(groups, "root string, n long")
    filled = splits.weighted_fill(frame, "root", "n", [("test", 0.1), ("train", 0.9)], "s")
    order = sorted((hashlib.sha256(f"s:{k}".encode()).hexdigest() if k else "", k or "", n) for k, n in groups)
    want, before, total = {}, 0, sum(n for _, n in groups)
    for _, k, n in order:
        want[k], before = "test" if before < 0.1 * total else "train", before + n
    assert {r.root or "": r.split for r in filled.collect()} == want and filled.columns == ["root", "n", "split"]
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert sum("_run" in x.split("windowspecdefinition(")[-1].split("ASC")[0] for x in windows) == len(windows) == 2


def test_strict_statistics_are_null_with_an_unknown_member(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, 3.0)], "k int, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(aggs.strict_stat(F.sum("v"), F.col("v")).alias("s")).collect()}
    assert got == {1: None, 2: 3.0}


def test_selection(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 3, "c"), (2, 3, "d"), (3, 1, "e")], "k int, o int, v string")
    got = {r.k: (r.status, r.chosen) for r in sampling.newest_eligible(df, "k", "o", F.col("o") > 2, "v").collect()}
    assert got == {1: ("inferred_newest_eligible", "b"), 2: ("ambiguous_latest_tie", None), 3: ("unavailable", None)}
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 4, "c"), (3, -1, "d"), (3, 2, "e")], "k int, o int, v string")
    got = {r.k: (r.status, r.chosen) for r in sampling.newest_eligible(df, "k", "o", F.lit(True), "v").collect()}
    assert got == {1: ("unique_eligible", "a"), 2: ("ambiguous_creation_order_unknown", None), 3: ("ambiguous_creation_order_unknown", None)}
    base, live = df.filter("k = 1"), df.filter("k > 1")
    assert {r.k: r.part for r in sampling.fill_to(base, live, "k", "o", 2).collect()} == {1: "base", 2: "overflow", 3: "live"}
    with pytest.raises(ValueError, match="too few"):
        sampling.fill_to(base, live, "k", "o", 9, strict=True)


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.base_token(F.lit("knight-ev1")).alias("b"), scalars.split_token(F.lit("knight-ev1-hero")).alias("s"), scalars.unix_seconds_of(F.lit("1700000000123")).alias("ms"),
        scalars.decision_window(F.lit(0)).alias("none"), scalars.decision_window(F.lit(11)).alias("w"), scalars.grid_cell(F.lit(17999), F.lit(31999)).alias("c"), scalars.grid_cell(F.lit(-1), F.lit(5)).alias("out"),
    ).first()
    more = spark.range(1).select(
        scalars.split_token(F.lit(" Knight-EV1-x ")).alias("s"), scalars.rotated(F.lit(0), F.lit(31_999)).alias("r"), scalars.scaled_level(F.lit(-7), F.lit(50)).alias("l"), scalars.decision_window(F.lit(12), first=2).alias("w"),
        scalars.source_group(F.lit("HTTPS://Host.X/A/b?c#d")).alias("g"), scalars.source_group(F.lit(None).cast("string"), F.lit(" id ")).alias("e"), scalars.clean_path(F.lit("A\\b//./c")).alias("p"), scalars.two_tags(F.array(F.lit("#a"), F.lit(" b"))).alias("t"),
        scalars.utc_seconds(F.lit("2024-01-01T00:00:00Z")).alias("u"), scalars.utc_seconds(F.lit("2024-01-01T00:00:00")).alias("v"), scalars.half_cell(F.lit(2500), F.lit(499)).alias("h"),
    ).first()
    assert (tuple(more.s), tuple(more.r), more.l, more.w, more.g, more.e, more.p, more.t, more.u, more.v, more.h) == (("knight-ev1-x", 0), (17_999, 0), -3, 7, "url:https://host.x/A/b", "explicit:id", "a/b/c", ["A", "B"], 1704067200, None, 2)
    assert (row.b, tuple(row.s), row.ms, row.none, row.w, row.c, row.out) == ("knight", ("knight", 3), 1700000000, None, 10, 575, None)


def test_sources(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"tag": "x", "n": 1}\nnot json\n{"tag": "y", "n": 2}\n')
    schema = T.StructType([T.StructField("tag", T.StringType()), T.StructField("n", T.LongType())])
    docs = tables.json_documents(spark, f"{tmp_path}/j", schema).cache()
    assert docs.filter("_bad is not null").count() == 1 and docs.filter("tag is not null").count() == 2
    (tmp_path / "l").mkdir()
    with gzip.open(tmp_path / "l/a.jsonl.gz", "wt") as f:
        f.write('{"tag": "x", "n": 1}\nbroken\n{"tag": "x", "n": 3}\n')
    assert [(r.tag, r.n) for r in tables.latest_lines(spark, f"{tmp_path}/l", schema, "tag").collect()] == [("x", 3)]
    (tmp_path / "t").mkdir()
    with tarfile.open(tmp_path / "t/a.tar", "w") as t:
        info = tarfile.TarInfo("m.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    assert [(r.member, r.size) for r in tables.tar_members(spark, f"{tmp_path}/t").collect()] == [("m.txt", 3)]
    out = f"{tmp_path}/out"
    tables.write_shards(spark.range(10).withColumn("split", F.lit("train")), out, "split", ["id"], 4)
    manifest = tables.file_manifest(spark, out).cache()
    assert manifest.count() == 3 and tables.verify_manifest(manifest, tables.file_manifest(spark, out)).isEmpty()


def test_stream_equals_batch(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "value")
    e.unionByName(e.limit(100)).repartition(3).write.parquet(f"{tmp_path}/in")
    rules = {"high": F.col("value") > 50}
    stream = spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in")
    incremental.run_available(incremental.dedupe_stream(stream, "event_id", rules), f"{tmp_path}/out", f"{tmp_path}/cp")
    got, want = spark.read.parquet(f"{tmp_path}/out"), incremental.validated(e, rules)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_assembler_breaks_on_a_gap(spark, tmp_path):
    rows = [("a", t) for t in (0, 1, 2, 3, 4, 5, 5, 6)] + [("b", t) for t in (0, 1, 3, 4)]
    spark.createDataFrame(rows, "k string, tick long").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, tick long").parquet(f"{tmp_path}/in")
    incremental.run_available(incremental.assemble(stream, "k", "tick"), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {(r.k, r.tick, r.status) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("a", 0, "ok"), ("a", 5, "ok"), ("b", 0, "ok"), ("b", 3, "broken")}
