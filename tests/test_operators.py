"""Fixture cases of the change-log operators."""

import pytest
from pyspark.sql import functions as F
from tidelog import conf, sinks, state
from tidelog.functions import convert as C
from tidelog.model import lsn_number, lsn_text
from tidelog.operators import catalog, exprfilter, replication, snapshot
from tidelog.operators.tablefilter import PatternError, TableFilter, parse_token, with_keywords

CASES = [
    ([], [], "public.test", False), (["public.test"], ["public.test"], "public.test", False), ([], ["public.test"], "public.test", True), ([], ["public.test"], "public.test2", False),
    (["public.test"], ["public.*"], "public.test", False), ([], ["public.*"], "public.test2", True), ([], ["public.*"], "public2.test", False), ([], ["*.test"], "public2.test", True),
    ([], ["public.test?a"], "public.test1a", True), ([], ["public.test?a"], "public.test11a", False), ([], ["t?p.test"], "toop.test", False), ([], ["public.test+a"], "public.test11a", True),
    ([], ["t+p.test"], "tp.test", False), ([], ["t+p.test"], "tap.test", True), ([], ["t+p.test?"], "tap.test11", False), ([], ['public."t\\*"'], "public.t\\*", True), ([], ['public."t\\+"'], "public.t\\+", True),
]


@pytest.mark.parametrize("excl,incl,name,want", CASES)
def test_table_filter(spark, excl, incl, name, want):
    f = TableFilter(excl, incl)
    assert f.enabled(*name.split(".")) is want
    df = spark.createDataFrame([tuple(name.split("."))], "s string, t string")
    assert df.select(f.column(F.col("s"), F.col("t"))).first()[0] is want


def test_tokens(spark):
    good = {"Customers5": "customers5", '"5Customers"': "5Customers", "dataField": "datafield", "_dataField1": "_datafield1", "ADGROUP": "adgroup", '"tableName~"': "tableName~", '"GROUP"': "GROUP", '"A""A"': 'A""A', '"A"A"': 'A""A'}
    assert {k: parse_token(k)[0] for k in good} == good
    for bad in ("fo(+o", "x" * 64, "%t", "t\\", "GROUP", "5Customers", "_dataField!"):
        with pytest.raises(PatternError):
            parse_token(bad)
    with pytest.raises(PatternError):
        TableFilter(includes=["foo.bar.baz"])
    assert "GROUP" in with_keywords(spark)


def test_schema_diff():
    col = lambda n, t="10": catalog.ColumnDef(n, t)
    a = [col("test1"), col("test2"), col("test3")]
    assert list(catalog.schema_diff(a, [*a, col("test4")])) == ["test4"]
    assert catalog.schema_diff(a, [a[0], col("test4"), a[2]]) == {"test4": "name:test2=>test4"}
    assert catalog.schema_diff(a, [a[0], a[1], col("test4")]) == {"test3": "name:test3=>test4"}
    d = catalog.schema_diff([col("test1", "10"), col("test2", "11"), col("test3", "12")], [col("test1", "10"), col("test3", "12")])
    assert list(d) == ["test2"] and d["test2"].startswith("dropped")
    assert catalog.schema_diff(a, a[:2])["test3"].startswith("dropped")
    assert catalog.schema_diff(a, [a[0], col("test2", "11"), a[2]]) == {"test2": "type:10=>11"}


def test_restart_point(spark):
    rows = [(0, None, 10000, 10000), (0, 20000, 10000, 20000), (21000, 20000, 10000, 21000), (19000, 20000, 10000, 20000)]
    df = spark.createDataFrame(rows, "c long, o long, s long, want long")
    assert all(r.got == r.want for r in df.withColumn("got", replication.restart_point(F.col("c"), F.col("o"), F.col("s"))).collect())
    for plugin, kind in (("pgoutput", "physical"), ("json", "logical")):
        with pytest.raises(ValueError):
            replication.check_slot(plugin, kind)


def test_lsn(spark):
    df = spark.createDataFrame([(0x16_B374D848,)], "n long").select(lsn_text(F.col("n")).alias("t")).select("t", lsn_number(F.col("t")).alias("n"))
    assert tuple(df.first()) == ("16/B374D848", 0x16_B374D848)


def test_converters(spark):
    row = spark.range(1).select(
        C.interval(F.lit(0), F.lit(0), F.lit(43200000000)).alias("i1"), C.interval(F.lit(2), F.lit(0), F.lit(0)).alias("i2"), C.date(F.lit("1900-01-01")).alias("d"), C.timetz_text(F.lit("12:00:12.054321Z07:30")).alias("tz"),
        C.timestamptz(F.lit("2027-03-01 15:01:12").cast("timestamp")).alias("t"), C.f64_text(F.lit(1e20)).alias("f"), C.f64_text(F.lit(1.5e-7)).alias("g"), C.f64_text(F.lit(-0.25)).alias("h"), C.g_text(F.lit(1234567.0)).alias("k"),
        C.ewkb(F.unhex(F.lit("010100000000000000000024C000000000000034C0"))).alias("geo"), C.json(F.lit('{"foo": "bar", "a": 1}')).alias("j"), C.json(F.lit("[1]")).alias("j2"), C.uuid(F.unhex(F.lit("F6DF43DE36FF40A59D81CAF6A79EB3F8"))).alias("u"),
        C.default_kind(F.lit("-3")).alias("k1"), C.default_kind(F.lit("x")).alias("k2"), C.array_of(F.array(F.lit("A"), F.lit(None)), C.macaddr).alias("arr"), C.version_number(F.lit("PostgreSQL 15.3 on x")).alias("v"),
    ).first()
    assert (row.i1, row.i2, row.d, row.tz, row.t) == (43200000000, 5259600000000, -25567, "19:30:12.054321", "2027-03-01T15:01:12Z")
    assert (row.f, row.g, row.h, row.k) == ("100000000000000000000", "0.00000015", "-0.25", "1.234567e+06")
    assert tuple(row.geo) == ("AAAAAAHAJAAAAAAAAMA0AAAAAAAA", 0) and row.j == '{"a":1,"foo":"bar"}' and row.j2 == "[1]"
    assert row.u == "f6df43de-36ff-40a5-9d81-caf6a79eb3f8" and (row.k1, row.k2, row.arr, row.v) == ("integer", "string", ["a", None], 150003)
    assert C.spark_type("date[]").simpleString() == "array<int>"


def test_filter_language(spark):
    df = spark.createDataFrame([(("u", (2,)),), (("c", (None,)),)], "value struct<op:string, before:struct<id:int>>")
    hit = lambda c: [bool(r[0]) for r in df.select(exprfilter.compile_condition(c)).collect()]
    assert hit('value.op == "u" && value.before.id == 2') == [True, False]
    assert hit('value.op startsWith "c" or not (value.before.id in [1, 2])') == [False, True]
    assert hit('(value.before.id ?? 7) > 5 ? true : value.op == "x"') == [False, True]
    for bad in ("nope(value.op) > 1", "value.op ===", "value.op == @"):
        with pytest.raises(exprfilter.FilterError):
            exprfilter.compile_condition(bad)
    with pytest.raises(exprfilter.FilterError):
        exprfilter.checked(df, exprfilter.compile_condition("value.before.id + 1"))


def test_pages(spark):
    df = spark.range(1, 26).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    got = [[tuple(r) for r in p.collect()] for p, _ in snapshot.pages(df, ["a", "b"], 7)]
    assert sum(got, []) == sorted(tuple(r) for r in df.collect()) and [len(p) for p in got] == [7, 7, 7, 4]
    assert list(snapshot.pages(df.limit(0), ["a", "b"], 7)) == []


def test_state(tmp_path):
    s = state.FileState(str(tmp_path / "s.json"))
    s.set_offset("foo", state.Offset(1000000, "2023-01-01", True, False, "foo-12345-12345", 1000))
    s.set_offset("foo", state.Offset(5))
    s.with_snapshot("x", lambda c: setattr(c.watermark("t"), "high", [9]))
    s.save()
    t = state.FileState(s.path)
    t.load()
    assert t.offsets == s.offsets and t.offsets["foo"].lsn == 1000000 and t.snapshots == s.snapshots
    with pytest.raises(KeyError):
        t.with_snapshot("y", print, create=False)


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text('[sink]\ntype = "kafka"\n[postgresql.events]\nupdate = false\n')
    c = conf.Config(conf.load(str(tmp_path / "c.toml")), {"TOPIC_PRE__FIX": "x", "POSTGRESQL_SNAPSHOT_BATCHSIZE": "50"})
    assert (c.get("sink.type"), c.get("topic.pre_fix"), c.get("postgresql.snapshot.batchsize"), c.get("sink.tombstone")) == ("kafka", "x", 50, False)
    assert c.switches() == {"r": True, "c": True, "u": False, "d": True, "t": True, "m": True}


def test_sinks():
    sent, waits, fails = [], [], iter([1, 1, 0])

    def send(*a):
        if next(fails):
            raise OSError
        sent.append(a)

    k = sinks.ClientSink(send)
    assert sinks.with_retry(lambda: k.emit("t", "k", "v"), sleep=waits.append) == 2 and sent == [("t", "k", "v", None)] and waits == [0.1, 0.2]
    with pytest.raises(OSError):
        sinks.with_retry(lambda: (_ for _ in ()).throw(OSError()), retries=1, sleep=waits.append)
    assert not sinks.register("kafka", print) and sinks.SINKS["kafka"] is sinks.ClientSink


def test_stream_source(spark, tmp_path):
    import json

    from tidelog.sources.wal import LogStream

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("".join(json.dumps({"lsn": i, "xid": i // 3}) + "\n" for i in range(1, 8)))
    spark.dataSource.register(LogStream)
    df = spark.readStream.format("tidelog").option("path", str(tmp_path / "in")).option("batch", "3").option("startLsn", "2").load()
    q = df.writeStream.format("memory").queryName("log").option("checkpointLocation", str(tmp_path / "cp")).start()
    for _ in range(60):
        q.awaitTermination(1)
        if spark.table("log").count() >= 5:
            break
    q.stop()
    assert [r.lsn for r in spark.table("log").orderBy("lsn").collect()] == [3, 4, 5, 6, 7]


def test_stream_source_of_equal_positions_and_unordered_files(tmp_path):
    import json

    from tidelog.sources.wal import LogReader

    put = lambda name, rows: (tmp_path / name).write_text("".join(json.dumps(dict(zip(("lsn", "seq", "msg_type"), r, strict=True))) + "\n" for r in rows))
    put("a.json", [(3, 0, "R"), (7, 1, "I"), (7, 0, "I"), (7, 3, "I"), (9, 0, "I")])
    put("b.json", [(2, 0, "I"), (6, 0, "I"), (7, 2, "I"), (8, 0, "R")])
    for batch in range(1, 11):
        reader = LogReader({"path": str(tmp_path), "batch": str(batch), "startlsn": "5"})
        got, at, cuts = [], reader.initialOffset(), []
        while True:
            rows, end = reader.read(at)
            rows = list(rows)
            if not rows:
                break
            assert end != at and rows == list(reader.readBetweenOffsets(at, end))
            got, at = got + rows, end
            cuts.append(len(rows))
        assert [(r[0], json.loads(r[1])["seq"]) for r in got] == [(3, 0), (6, 0), (7, 0), (7, 1), (7, 2), (7, 3), (8, 0), (9, 0)], batch
        assert max(cuts) <= batch + 3


def test_open_transactions_wait(spark, tmp_path):
    from tidelog.streaming.transactions import committed

    rows = [(1, 10, "I", "a"), (2, 11, "I", "b"), (1, 12, "I", "c"), (1, 13, "C", "")]
    spark.createDataFrame(rows, "xid long, lsn long, kind string, body string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("xid long, lsn long, kind string, body string").parquet(str(tmp_path / "in"))
    q = committed(stream).writeStream.outputMode("append").format("memory").queryName("txn").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.xid, r.lsn) for r in spark.table("txn").orderBy("lsn").collect()] == [(1, 10), (1, 12)]
