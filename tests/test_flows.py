"""Joins, packing, parsing, telemetry, sources, sinks, providers, cascade and streams."""

import gzip
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.functions.lexicon import LABELS
from loomtext.operators import joins, packing, parsing, providers, sampling, telemetry
from loomtext.plans import cascade
from loomtext.sources import jsonl, sinks
from loomtext.streaming import labels as streams


def _rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_merge(spark):
    labels = spark.createDataFrame([("x", "English", 1), ("x", "Sheng", 2), ("y", "Other", 3)], "id string, language string, n int")
    originals = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "c"), ("z", "d"), (None, "e"), ("w", " ")], "id string, body string")
    assert _rows(joins.merge_labels(originals, labels, "n"), "id", "body", "slug") == [("x", "a", "sheng"), ("x", "b", "sheng"), ("y", "c", "unknown"), ("z", "d", "unknown")]


def test_first_wins(spark):
    rows = spark.createDataFrame([(" a ", "English", 1), ("a", "Sheng", 2), ("", "Swahili", 3)], "id string, language string, n int")
    assert _rows(joins.first_wins(rows, "id", "n"), "id", "language") == [("a", "English")]


def test_resume_cache_and_missing(spark):
    items = spark.createDataFrame([("a", "t1"), ("b", "t2"), (None, "t3")], "id string, text string")
    done = spark.createDataFrame([("a",), (None,)], "id string")
    assert _rows(joins.unprocessed(items, done)) == [("b", "t2"), (None, "t3")]
    cache = spark.createDataFrame([("h1", "old"), ("h2", "kept")], "h string, label string")
    new = spark.createDataFrame([("h1", "first", 1), ("h1", "last", 2), ("h3", "new", 1)], "h string, label string, n int")
    assert _rows(joins.upsert_cache(cache, new, "n"), "h", "label") == [("h1", "last"), ("h2", "kept"), ("h3", "new")]
    assert _rows(joins.delete_from_cache(cache, new)) == [("h2", "kept")]
    results = spark.createDataFrame([("a", "", "English"), ("f", None, "Sheng"), ("b", "own", "")], "id string, text string, language string")
    assert _rows(joins.align_results(results, items.where("id IS NOT NULL"))) == [("a", "t1", "English"), ("b", "own", ""), ("f", "", "Sheng")]
    assert _rows(joins.missing_from_results(items.where("id IS NOT NULL"), results)) == [("b", "t2")]


def test_counts(spark):
    rows = spark.createDataFrame([("English",), ("Other",), (None,), ("English",)], "l string")
    assert _rows(joins.label_counts(rows, F.col("l"), LABELS)) == sorted([("English", 2), ("Swahili", 0), ("Sheng", 0), ("English and Swahili", 0), ("Unknown", 2)], key=repr)
    assert _rows(joins.label_counts(rows, F.col("l"))) == [("English", 2), ("Other", 1), ("Unknown", 1)]


@pytest.mark.parametrize("sizes, want", [([1000, 1200, 900, 2600, 10, 10], [0, 0, 1, 2, 3, 3]), ([1] * 31, [0] * 15 + [1] * 15 + [2])])
def test_budget_batches(spark, sizes, want):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(sizes)], "s long, i long, t long")
    assert [r.batch for r in packing.budget_batches(df, "s", "i", "t").orderBy("i").collect()] == want


@pytest.mark.parametrize("sizes, want", [([4000, 2000, 1500, 100], [0, 0, 0, 1]), ([1] * 41, [0] * 40 + [1])])
def test_flush_batches(spark, sizes, want):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(sizes)], "s long, i long, t long")
    out = packing.flush_batches(df, "s", "i", "t")
    assert [r.batch for r in out.orderBy("i").collect()] == want
    assert packing.batch_totals(out, "s", "t").agg(F.sum("batch_tokens")).first()[0] == sum(sizes)


def test_samples(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    assert sampling.sample_n(df, 10, "s").collect() == sampling.sample_n(df, 10, "s").collect()
    assert sampling.sample_n(df, 5000, "s").count() == 1000 and 40 < sampling.bernoulli(df, 0.08, "s").count() < 130


RESPONSES = [
    ('[{"id":"a","language":"Sheng"}]', 1, 1, 1),
    ('Sure: [{"id":"a","language":"Sheng"}] ok', None, 1, 1),
    ('{"id":"a","language":"Sheng"}\n- {"id":"b","language":"English"} ;', None, None, 2),
    ('{"id":"a"}', None, None, 0),
    ("nothing", None, None, 0),
]


@pytest.mark.parametrize("text, strict, salvaged, lenient", RESPONSES)
def test_responses(spark, text, strict, salvaged, lenient):
    r = spark.createDataFrame([(text,)], "t string").select(parsing.strict_array(F.col("t")).alias("a"), parsing.salvaged_array(F.col("t")).alias("b"), parsing.lenient(F.col("t")).alias("c"), parsing.json_lines(F.col("t")).alias("d")).first()
    size = lambda x: None if x is None else len(x)
    assert (size(r.a), size(r.b), len(r.c.results)) == (strict, salvaged, lenient)
    assert lenient or r.c.invalid >= 1


def test_telemetry(spark):
    rows = [(1, 10.0, 0, True), (1, 12.0, 100, True), (1, 2000.0, 400, False), (1, 2001.0, 500, False), (2, 5.0, 7, True)]
    df = spark.createDataFrame(rows, "run long, s double, total long, ok boolean").withColumn("ts", F.timestamp_seconds("s"))
    assert [r.rate for r in telemetry.trailing_rate(df, "run", "ts", "total").where("run = 1").orderBy("ts").collect()] == [None, 50.0, None, 100.0]
    assert [r.rate for r in telemetry.delta_rate(df, "run", "ts", "total").where("run = 1").orderBy("ts").collect()] == [None, 50.0, pytest.approx(300 / 1988), 100.0]
    assert [r.streak for r in telemetry.streaks(df, "run", "ts", F.col("ok")).where("run = 1").orderBy("ts").collect()] == [1, 2, 1, 2]
    one = spark.range(1).select(telemetry.ema(F.array(F.lit(-1.0), F.lit(10.0), F.lit(0.0), F.lit(20.0))).alias("x"), telemetry.ema(F.array(F.lit(0.0))).alias("y")).first()
    assert one.x == pytest.approx(12.0) and one.y is None


def test_tuner(spark):
    t = telemetry.Tuner(telemetry.PRESETS["v4"])
    assert [t.event(i, False) for i in range(3)][-1] == (18, 40)
    assert [t.event(10 + i, True) for i in range(20)][-1] == (18, 40) and t.event(200, True) == (19, 42)
    v1 = telemetry.Tuner(telemetry.PRESETS["v1"])
    assert [v1.event(i, False) for i in range(3)][-1] == (8, 30)
    log = spark.createDataFrame([(1, i, float(i), i % 5 > 2, 1.0, 200.0, 100.0) for i in range(50)] + [(2, 0, 0.0, True, None, None, None)], "run long, seq long, t double, success boolean, rate double, latency double, tokens double")
    got = telemetry.tune(log)
    assert got.count() == 51 and got.where("workers < 1 OR batch < 1").count() == 0


def test_provider_faults(spark):
    class Faulty:
        """Partial, repeated, foreign, unknown and failing answers."""

        def label(self, items):
            if len(items) > 1 and any(x["text"] == "boom" for x in items):
                raise RuntimeError("Content Exists Risk")
            out = [{"id": "foreign", "language": "English"}]
            for x in items:
                if x["text"] == "boom":
                    raise RuntimeError("429 rate limit")
                if x["text"] == "odd":
                    out.append({"id": x["id"], "language": "Klingon"})
                elif x["text"] != "lost":
                    out += [{"id": x["id"], "language": "Sheng"}, {"id": x["id"], "language": "English"}]
            return out

    items = spark.createDataFrame([("1", "fine"), ("2", "lost"), ("3", "odd"), ("4", "boom"), ("5", "fine")], "id string, text string").coalesce(1)
    got = {r.id: (r.label, r.failure) for r in providers.label_batches(items, Faulty(), batch=2).collect()}
    assert got == {"1": ("Sheng", None), "2": (None, "empty_response"), "3": (None, "unknown_label"), "4": (None, "rate_limit"), "5": ("Sheng", None)}


def test_hash_provider_is_its_expression(spark):
    items = spark.createDataFrame([(str(i), f"t{i} é") for i in range(50)], "id string, text string")
    both = providers.label_batches(items, providers.HashProvider()).join(items, "id").withColumn("e", providers.hash_label(F.col("text")))
    assert both.where("label = e").count() == 50


def test_hints_reach_the_provider(spark):
    class Hinted:
        def label(self, items):
            return [{"id": x["id"], "language": x["hint"]} for x in items]

    items = spark.createDataFrame([("1", "t", "Sheng"), ("2", None, None)], "id string, text string, hint string")
    assert _rows(providers.label_batches(items, Hinted())) == [("1", "Sheng", None), ("2", None, "empty_response")]


def test_cascade(spark):
    items = spark.createDataFrame([("1", "The weather is nice today"), ("2", "mimi"), ("3", "mimi"), ("4", "zz yy"), ("5", "zz yy"), ("6", "x"), (None, "no id here at all"), ("7", "done already today my")], "id string, text string")
    cache = spark.createDataFrame([(items.select(X.hash_key(F.lit("mimi"))).first()[0], "Swahili")], "h string, label string")
    asked = spark.sparkContext.accumulator(0)

    class Counting(providers.HashProvider):
        def label(self, batch):
            asked.add(len(batch))
            return super().label(batch)

    out = cascade.run_cascade(items, done=spark.createDataFrame([("7",)], "id string"), cache=cache, provider=Counting())
    got = {r.id: (r.label, r.origin) for r in out.collect()}
    assert set(got) == {"1", "2", "3", "4", "5"} and got["1"] == ("English", "rule") and got["2"] == got["3"] == ("Swahili", "cache") and got["4"] == got["5"] and got["4"][1] == "model"
    assert asked.value == 1  # each distinct text once, however often the result is read
    assert cascade.run_cascade(items, done=items.select("id")).count() == 0
    assert cascade.new_cache_rows(out).count() == 2
    outcomes, renewed = cascade.recheck(out, cache, providers.HashProvider(), 1.0, 1.0)
    assert outcomes.count() == 3 and renewed.where(F.col("h") == cache.first().h).count() == 1
    assert cascade.checkpoint_policy(10, 10) == "restart" and cascade.checkpoint_policy(3, 10) == "resume"


def test_recheck_evaluates_its_sample_once(spark):
    """Labels are evaluated once a row, though outcomes and the cache are both read."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def label(t):
        made.add(1)
        return "Sheng"

    texts = [f"text {i} é" for i in range(20)]
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string").repartition(2, "text")
    labelled = items.select("id", "text", label("text").alias("label"), F.lit("rule").alias("origin"))
    outcomes, renewed = cascade.recheck(labelled, spark.createDataFrame([], "h string, label string"), providers.HashProvider(), rule_share=1.0)
    expected = {r.h: r.e for r in items.select(X.hash_key(F.col("text")).alias("h"), providers.hash_label(F.col("text")).alias("e")).collect()}
    assert {r.h: r.label for r in renewed.collect()} == {h: e for h, e in expected.items() if e != "Sheng"}
    assert outcomes.count() == 20 and outcomes.where("outcome = 'match'").count() == sum(e == "Sheng" for e in expected.values())
    assert made.value == 20


def test_provider_batches_are_whole_across_frames(spark, monkeypatch):
    """Frames are bounded by bytes, and a provider's batches don't end with them."""
    calls = spark.sparkContext.accumulator(0)

    class Counting(providers.HashProvider):
        def label(self, batch):
            calls.add(1)
            return super().label(batch)

    items = spark.createDataFrame([(str(i), "é" * 2000) for i in range(43)], "id string, text string").coalesce(1)
    monkeypatch.setattr(providers, "ARROW_BYTES", "40k")
    got = providers.label_batches(items, Counting(), batch=8).where("label IS NOT NULL").collect()
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert sorted(int(r.id) for r in got) == list(range(43)) and calls.value == 6
    frames = [pa.RecordBatch.from_pydict({"x": list(range(k, k + n))}) for k, n in ((0, 3), (3, 0), (3, 9), (12, 1))]
    assert [f.column(0).to_pylist() for f in providers._in_whole_batches(iter(frames), 4)] == [list(range(12)), [12]]


def test_kept_columns_come_back_whole(spark):
    items = spark.createDataFrame([(str(i), f"t{i}", None if i % 2 else 2**62 + i) for i in range(90)], "id string, text string, n long")
    got = providers.label_batches(items, providers.HashProvider(), keep=("n",)).where("label IS NOT NULL AND failure IS NULL")
    assert _rows(got, "id", "n") == _rows(items, "id", "n")


def test_presets_conserve_rows(spark):
    items = spark.createDataFrame([(str(i), f"it's text {i % 3}") for i in range(9)], "id string, text string")
    for name, preset in cascade.PRESETS.items():
        assert cascade.run_cascade(items, preset).count() == 9, name


def test_read_jsonl(spark, tmp_path):
    lines = ['{"id":"a","body":"","text":"t"}', '{"_id":"b","body":"b","text":"t"}', "", "  ", '{"id":"c","body":"x"', "[1]", "7"]
    with gzip.open(tmp_path / "x.jsonl.gz", "wt") as f:
        f.write("\n".join(lines))
    assert _rows(jsonl.read_jsonl(spark, str(tmp_path / "x.jsonl.gz")), "id", "text") == [("a", "t"), ("b", "b")]
    assert _rows(jsonl.read_jsonl(spark, str(tmp_path / "x.jsonl.gz"), texts=jsonl.TEXT_FIRST), "id", "text") == [("a", "t"), ("b", "t")]
    assert _rows(jsonl.skipped(spark, str(tmp_path / "x.jsonl.gz"))) == [("malformed_json", 3)]
    (tmp_path / "a.json").write_text(' [{"id":"a","body":"x"}, 5, {"cid":"b","text":"y"}]')
    assert _rows(jsonl.read_json_array(spark, str(tmp_path / "a.json")), "id", "text") == [("a", "x"), ("b", "y")]


def test_detector_lines(spark, tmp_path):
    lines = ['{"body":" ","text":"t"}', '{"body":5,"comment":"c"}', '"quoted"', "plain words", "123", "null", '["a"]', "", "last"]
    (tmp_path / "d.txt").write_text("\n".join(lines))
    assert _rows(jsonl.detector_lines(spark, str(tmp_path / "d.txt"))) == [(1, "t"), (2, "c"), (3, "quoted"), (4, "plain words"), (9, "last")]


def test_checkpoints_and_label_files(spark, tmp_path):
    (tmp_path / "done.txt").write_text("a b\nc\nc\n\n")
    assert _rows(jsonl.read_checkpoint(spark, str(tmp_path / "done.txt"))) == [("a b",), ("c",)]
    assert _rows(jsonl.read_checkpoint(spark, str(tmp_path / "done.txt"), split_on_space=True)) == [("a",), ("b",), ("c",)]
    (tmp_path / "l").mkdir()
    for name in ("one.jsonl", "temp_one.jsonl"):
        (tmp_path / "l" / name).write_text(json.dumps({"id": name, "language": "English"}))
    assert _rows(jsonl.read_label_files(spark, str(tmp_path / "l")), "id") == [("one.jsonl",)]
    assert spark.createDataFrame([('{"Language":"x"}',), ('{"label":""}',)], "v string").select(jsonl.label_of(F.col("v")).alias("l")).collect() == [("x",), ("Unknown",)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("1", "é", "English"), ("2", "b", "English and Swahili"), ("3", "c", "Other"), ("4", None, "English")], "id string, text string, language string")
    sinks.write_by_label(rows, str(tmp_path / "by"))
    assert sorted(p.name for p in (tmp_path / "by").iterdir() if p.is_dir()) == ["slug=english", "slug=mixed"]
    sinks.write_jsonl(rows.coalesce(1), str(tmp_path / "j"), part_rows=3)
    parts = [p for p in (tmp_path / "j").iterdir() if p.suffix == ".json"]
    assert len(parts) == 2 and "é" in "".join(p.read_text() for p in parts)
    sinks.write_checkpoint(rows, str(tmp_path / "c"))
    assert jsonl.read_checkpoint(spark, str(tmp_path / "c")).count() == 4
    meta = sinks.run_metadata(joins.label_counts(rows, F.col("language")), run="r1").first()
    assert meta.run == "r1" and meta.total == 4 and meta.language_counts["English"] == 2


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text('{"id":"1","body":"The weather is nice today"}\n{"id":"2","body":"zz"}\nbad\n')
    def run():
        q = streams.run_stream(streams.stream_items(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination()
        return q

    assert streams.progress(run()).agg(F.sum("rows")).first()[0] == 3
    (tmp_path / "in" / "2.jsonl").write_text('{"id":"3","body":"mimi na wewe"}\n')
    run()
    got = {r.id: r.label for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"] == "English" and got["3"] == "Swahili"
    q = streams.distinct_texts(streams.stream_items(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("d").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("d").count() == 3


def test_line_numbers_over_splits(spark, tmp_path):
    lines = ["" if i % 7 == 0 else f"line {i} " + "x" * (i % 50) for i in range(1, 5001)]
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = jsonl.numbered_lines(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 1
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name in ("a.txt", "b.txt"):
        assert sorted((r.line_id, r.value) for r in rows if r.file.endswith(name)) == list(enumerate(lines, 1))


def test_strip_is_linear(spark):
    import time

    texts = [" " * 200_000, "x" + " " * 200_000 + "y", "\u3000 \x1c a b\x85 ", "\n" * 100_000 + "z", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    began = time.monotonic()
    assert [r.s for r in df.select("id", X.strip(F.col("t")).alias("s")).orderBy("id").collect()] == [t if t is None else t.strip() for t in texts]
    assert time.monotonic() - began < 20


def test_no_local_folder_on_a_cluster():
    class Conf:
        get = staticmethod(lambda *a: None)

    class Cluster:
        conf = Conf
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        cascade.shared_folder(Cluster)
