"""Resumption: statuses, policies, and runs that die between a batch's write and its commit."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from folioframe.streaming import resume as R

KIND = StructType([StructField("k", LongType()), StructField("text", StringType()), StructField("error", StringType())])
LINES = ['{"k": 1, "text": "a"}', '{"k": 2, "error": "late"}', '{"k": 3, "text": " ", "error": ""}', "", '{"text": "no key"}', '{"k": 2, "text": "b"}', '{"k": 4, "text": "cu']


def test_statuses_and_policies(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text("\n".join(LINES))
    log = R.load(spark, str(tmp_path), KIND, "k", result="text")
    assert sorted((r.status, r.k) for r in log.where("k is not null").collect()) == [("complete", 1), ("complete", 2), ("empty", 3), ("error", 2)]
    assert {r.status: (r.rows, r["keys"]) for r in R.log_summary(log, "k").collect()} == {"complete": (2, 2), "error": (1, 1), "empty": (1, 1), "torn": (2, 0)}
    work = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, None)], "k long")
    left = lambda policy: sorted((r.k for r in R.remaining(work, log, "k", policy).collect()), key=str)
    assert left("complete_only") == [3, 4, 5, None] and left("any_row") == [4, 5, None]
    with pytest.raises(ValueError):
        R.done(log, "other")
    assert R.load(spark, f"{tmp_path}/none", KIND, "k").count() == 0


def test_batches_once(spark, tmp_path):
    sink = R.BatchSink(spark, f"file://{tmp_path}/out", "r1")
    rows = spark.createDataFrame([(1, "a", None)], KIND)
    assert sink.write(rows, 0) and not sink.write(rows, 0) and sink.write(rows, 1) and R.BatchSink(spark, sink.path, "r2").write(rows, 0)
    assert R.load(spark, sink.path, KIND, "k").count() == 3
    # What a killed run staged is no row, and a renamed batch stays.
    (tmp_path / "out" / "_staged-x").mkdir()
    (tmp_path / "out" / "_staged-x" / "part-0.json").write_text('{"k": 9}\n')
    assert R.load(spark, sink.path, KIND, "k").where("k = 9").count() == 0


def test_restart_of_an_output_without_results(spark, tmp_path):
    sink = R.BatchSink(spark, f"file://{tmp_path}/out")
    work = spark.createDataFrame([(1,), (2,)], "k long")
    sink.write(spark.createDataFrame([(1, None, "late")], KIND), 0)
    assert R.resume(spark, work, sink, KIND, "k", "text", restart_empty=False).count() == 2 and sink.has(0)
    assert R.resume(spark, work, sink, KIND, "k", "text", "any_row").count() == 1 and sink.has(0)
    assert R.resume(spark, work, sink, KIND, "k", "text").count() == 2 and not sink.has(0)
    sink.write(spark.createDataFrame([(1, "a", None), (2, None, "late")], KIND), 0)
    assert [r.k for r in R.resume(spark, work, sink, KIND, "k", "text").collect()] == [2] and sink.has(0)


def drop(folder, number, keys):
    folder.mkdir(exist_ok=True)
    (folder / f"{number}.json").write_text("".join(json.dumps({"k": k}) + "\n" for k in keys))


@pytest.mark.parametrize("dies", ["before the rename", "after the write"])
def test_killed_between_write_and_commit(spark, tmp_path, dies):
    asked, work = [], tmp_path / "work"
    out, checkpoint = f"file://{tmp_path}/out", f"{tmp_path}/checkpoint"

    class Dying(R.BatchSink):
        def write(self, rows, batch):
            if dies == "after the write":
                super().write(rows, batch)
            else:
                rows.write.json(f"{self.path}/_staged-dead")
            raise RuntimeError("killed")

    def call(left):
        asked.append(sorted(r.k for r in left.collect()))
        return left.withColumns({"text": F.concat(F.lit("t"), F.col("k")), "error": F.when((F.col("k") == 3) & F.lit(len(asked) < 3), "late")})

    def run(sink):
        stream = spark.readStream.schema("k long").json(str(work))
        q = R.process(stream, sink, checkpoint, call, KIND, "k", "text")
        q.awaitTermination(60)

    drop(work, 1, [1, 2, 3])
    with pytest.raises(Exception):
        run(Dying(spark, out))
    run(R.BatchSink(spark, out))
    # The batch is given again: after a whole write nobody is asked again, before it everybody is.
    assert asked == ([[1, 2, 3]] if dies == "after the write" else [[1, 2, 3]] * 2)
    drop(work, 2, [2, 3, 4])
    run(R.BatchSink(spark, out))
    assert asked[-1] == [3, 4]  # 2 is done, 3 was an error
    rows = sorted((r.k, r.status) for r in R.load(spark, out, KIND, "k", result="text").collect())
    assert [k for k, s in rows if s == "complete"][:2] == [1, 2] and len([k for k, _ in rows if k in (1, 2, 4)]) == 3 and (3, "error") in rows
