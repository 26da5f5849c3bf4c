"""Folder topics: offsets, whole lines, splits, restarts."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from fieldwatch.sources.topics import BYTE_BITS, FORMAT, _Folder, register
from fieldwatch.streaming.sources import topic_batch, topic_stream

OLD = 1_700_000_000


def put(root, name, text, at=OLD, mode="w"):
    path = f"{root}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline="") as f:
        f.write(text)
    os.utime(path, (at, at))


def read(spark, root, **options):
    register(spark)
    return spark.read.format(FORMAT).options(path=str(root), **options).load()


class Sink:
    """Collects (value, seq) of each micro-batch of a topic."""

    def __init__(self, spark, root, checkpoint, **how):
        self.spark, self.root, self.checkpoint, self.how, self.batches = spark, str(root), str(checkpoint), how, []

    def run(self, trigger=None):
        """Reads what there is; a new query on the old checkpoint each time."""
        q = self.start(trigger)
        q.awaitTermination() if trigger else q.processAllAvailable()
        q.stop()
        return [v for b in self.batches for v, _ in b]

    def start(self, trigger=None):
        def take(batch, n):
            self.batches.append([(r.value, r.seq) for r in batch.orderBy("seq").collect()])

        w = topic_stream(self.spark, "t", folder=self.root, **self.how).writeStream.foreachBatch(take).option(
            "checkpointLocation", self.checkpoint)
        return (w.trigger(availableNow=True) if trigger else w.trigger(processingTime="0 seconds")).start()


def test_rows_as_kafka_has_them(spark, tmp_path):
    put(tmp_path, "a.ndjson", "x\n\ny\r\n")
    put(tmp_path, "partition=3/b.ndjson", "é\nlast line without an end")
    put(tmp_path, "_hidden", "no\n")
    put(tmp_path, "sub/.part.crc", "no\n")
    df = read(spark, tmp_path, topic="fleet")
    assert [f.simpleString() for f in df.schema] == ["key:binary", "value:binary", "topic:string", "partition:int",
                                                     "offset:bigint", "timestamp:timestamp"]
    got = [(r.key, bytes(r.value).decode(), r.topic, r.partition, r.offset, r.t)
           for r in df.withColumn("t", F.unix_seconds("timestamp")).orderBy("partition", "offset").collect()]
    assert got == [(None, "x", "fleet", 0, 0, OLD), (None, "y", "fleet", 0, 3, OLD), (None, "é", "fleet", 3, 0, OLD),
                   (None, "last line without an end", "fleet", 3, 3, OLD)]
    assert read(spark, tmp_path / "absent").count() == 0


def test_files_of_one_time_keep_a_total_order(spark, tmp_path):
    """Two files of one modification time do not interleave, however tasks split them."""
    for name in ("b", "a"):
        put(tmp_path, name, "".join(f"{name}{k}{'.' * (k % 90)}\n" for k in range(3000)))
    put(tmp_path, "c", "c0\n", at=OLD - 5)
    df = read(spark, tmp_path, splitBytes="7001")
    assert df.rdd.getNumPartitions() > 30
    rows = [(r.offset, bytes(r.value).decode().rstrip(".")) for r in df.orderBy("offset").collect()]
    assert [v for _, v in rows] == ["c0"] + [f"a{k}" for k in range(3000)] + [f"b{k}" for k in range(3000)]
    assert len({o for o, _ in rows}) == 6001


def test_a_file_of_two_million_lines(spark, tmp_path):
    n = 2_000_000
    put(tmp_path, "big", "".join(f"{k}\n" for k in range(n)))
    df = read(spark, tmp_path, splitBytes=str(1 << 20)).select(F.col("value").cast("string").cast("long").alias("v"), "offset")
    row = df.agg(F.count("v"), F.countDistinct("offset"), F.sum("v"), F.max("offset")).first()
    assert tuple(row)[:3] == (n, n, n * (n - 1) // 2) and row[3] < 1 << BYTE_BITS
    out_of_order = df.join(df.select((F.col("v") - 1).alias("v"), F.col("offset").alias("following")), "v").where(
        "following <= offset").count()
    assert out_of_order == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64])
def test_every_line_once_whatever_the_splits(tmp_path, size):
    lines = ["", "a", "bb", "", "ccc", "d" * 20, "é", "end"]
    for end in ("\n", ""):
        put(tmp_path, "f", "\n".join(lines) + end)
        folder = _Folder({"path": str(tmp_path), "splitBytes": str(size)})
        got = [(o, bytes(v).decode()) for part in folder.ranges({}, folder.advance({})) for b in folder.read(part)
               for o, v in zip(b.column("offset").to_pylist(), b.column("value").to_pylist())]
        assert [v for _, v in sorted(got)] == [x for x in lines if x] and len(dict(got)) == len(got)


@pytest.mark.parametrize("trigger", [None, "availableNow"])
def test_latest_takes_only_what_comes_later_and_a_restart_goes_on_inside_a_file(spark, tmp_path, trigger):
    root = tmp_path / "t"
    put(root, "one", "old 1\nold 2\n")
    s = Sink(spark, root, tmp_path / "ckpt", starting_offsets="latest")
    assert s.run(trigger) == []
    put(root, "one", "new 1\nnew 2\nhalf", mode="a", at=time.time())
    put(root, "two", "two 1\n")
    assert s.run(trigger) == ["new 1", "new 2", "two 1"]  # the half line waits
    put(root, "one", " whole\nnew 3\n", mode="a", at=time.time())
    os.remove(root / "two")  # archived meanwhile
    put(root, "three", "three 1\n", at=OLD - 100)  # older than what was read, but found later
    assert s.run(trigger) == ["new 1", "new 2", "two 1", "half whole", "new 3", "three 1"]
    assert s.run(trigger)[6:] == []
    seqs = [q for b in s.batches for _, q in b]
    assert len(set(seqs)) == len(seqs)
    in_one = [q for b in s.batches for v, q in b if "new" in v or "half" in v]
    assert in_one == sorted(in_one)
    assert [q for b in s.batches for v, q in b if v == "three 1"] > [q for b in s.batches for v, q in b if v == "two 1"]


def test_limits_cut_batches_at_lines(spark, tmp_path):
    root = tmp_path / "t"
    for k in range(3):
        put(root, f"f{k}", "".join(f"{k} {j:03d}\n" for j in range(100)), at=OLD + k)
    s = Sink(spark, root, tmp_path / "ckpt", starting_offsets="earliest", max_bytes=250)
    assert s.run() == [f"{k} {j:03d}" for k in range(3) for j in range(100)]
    assert len(s.batches) >= 7 and max(map(len, s.batches)) <= 43
    put(root, "f9", "".join(f"9 {j:03d}\n" for j in range(100)))
    before = len(s.batches)
    assert len(s.run()) == 400 and len(s.batches) - before >= 2  # the limit holds after a restart too


def test_explicit_offsets(spark, tmp_path):
    put(tmp_path, "a", "a0\na1\na2\n", at=OLD)
    put(tmp_path, "b", "b0\nb1\n", at=OLD + 1)
    put(tmp_path, "partition=1/c", "c0\nc1\n")
    rows = {bytes(r.value).decode(): r.offset for r in read(spark, tmp_path).collect()}
    values = lambda **o: sorted(r.value for r in topic_batch(spark, "t", folder=str(tmp_path), **o).collect())
    assert values(starting_offsets=json.dumps({"0": rows["a2"], "1": -1})) == ["a2", "b0", "b1"]
    assert values(starting_offsets=json.dumps({"0": rows["b1"]})) == ["b1", "c0", "c1"]
    assert values(ending_offsets=json.dumps({"0": rows["b1"], "1": rows["c0"]})) == ["a0", "a1", "a2", "b0"]
    assert values(starting_offsets="latest") == []


def test_a_file_that_shrank_is_an_error(tmp_path):
    put(tmp_path, "a", "one\ntwo\n")
    folder = _Folder({"path": str(tmp_path)})
    known = folder.advance({})
    put(tmp_path, "a", "one\n")
    with pytest.raises(ValueError, match="were read"):
        folder.advance(known)
