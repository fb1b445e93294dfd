"""Streams whose files and batches grow with their input, and calls of a state store per request."""

from types import SimpleNamespace

from compare import connect, differences
from pyspark.sql import functions as F

from tessera.plans import corpus
from tessera.streaming import replies

FOLDER = "/root/testdata/sf0.001"


def test_encoding_stream_takes_more_files_for_more_documents(spark, monkeypatch):
    batches, read = [], corpus.read_new_files

    def watched(spark, path, schema, **options):
        batches.append((spark.read.parquet(path).select(F.input_file_name()).distinct().count(), options["files_per_batch"]))
        return read(spark, path, schema, **options)

    monkeypatch.setattr(corpus, "read_new_files", watched)
    monkeypatch.setattr(corpus, "STREAM_FILE_DOCS", 10, raising=False)
    query, sql = corpus.QUERIES["stream_equals_batch"]
    assert differences(spark, connect(FOLDER), query, sql, FOLDER) is None
    (first, taken), (both, taken_again) = batches
    assert first >= 8 and both >= 16 and taken == taken_again == 5


class _State:
    def __init__(self, calls):
        self.calls, self.held = calls, []

    def __getattr__(self, name):
        def call(*values):
            self.calls.append(name)
            if name == "exists":
                return bool(self.held)
            if name == "get":
                return iter(self.held) if self.listed else self.held[0] if self.held else None
            if name == "update":
                self.held = [values[0]]
            elif name == "appendValue":
                self.held.append(values[0])
            elif name == "appendList":
                self.held += values[0]
            elif name == "clear":
                self.held = []

        return call


class _Handle:
    def __init__(self):
        self.calls, self.timers = [], set()

    def state(self, listed):
        found = _State(self.calls)
        found.listed = listed
        return found

    def getListState(self, *_):
        return self.state(True)

    def getValueState(self, *_):
        return self.state(False)

    def listTimers(self):
        self.calls.append("listTimers")
        return list(self.timers)

    def registerTimer(self, at):
        self.calls.append("registerTimer")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls.append("deleteTimer")
        self.timers.discard(at)


def _chunk(seq, token=None, done=False, error=None):
    """A chunk as the processor gets it."""
    at = SimpleNamespace(timestamp=lambda: 1000.0 + seq)
    words = {"seqs": None, "tokens": None} if token is None else {"seqs": [seq], "tokens": [token]}
    return {**words, "until": seq if done or error else None, "error": error, "at": at}


def test_a_visit_makes_few_calls_to_the_state_store():
    handle = _Handle()
    processor = replies._Replies("request_id", "at", 60_000)
    processor.init(handle)

    def visit(key, *rows):
        handle.calls.clear()
        told = [tuple(r) for r in processor.handleInputRows((key,), iter(rows), None)]
        return told, len(handle.calls)

    told, calls = visit(1, _chunk(0, "a"), _chunk(2, done=True), _chunk(1, " b"))
    assert told == [(1, "a b", "ok")] and calls <= 1 and not handle.timers
    told, calls = visit(2, _chunk(1, " y"), _chunk(2, done=True, error="boom"))
    assert not told and calls <= 4 and len(handle.timers) == 1
    told, calls = visit(2, _chunk(0, "x"))
    assert told == [(2, "x y", "error")] and calls <= 5 and not handle.timers
    told, _ = visit(3, _chunk(0, "x"))
    told, calls = visit(3, _chunk(5, "z"))
    assert not told and calls <= 5 and handle.timers == {1_065_000}
    handle.calls.clear()
    assert [tuple(r) for r in processor.handleExpiredTimer((3,), None, None)] == [(3, "xz", "incomplete")]


def test_tokens_of_a_request_come_as_one_row(spark):
    schema = "request_id long, seq long, token string, done boolean, error string"
    rows = [(1, i, f"w{i}", False, None) for i in range(50)] + [(2, 0, None, False, None), (2, 1, "x", True, None)]
    rows += [(1, 50, None, None, "boom"), (3, 0, "", False, None)]
    chunks = spark.createDataFrame(rows, schema).coalesce(1).withColumn("at", F.timestamp_seconds(F.col("seq")))
    packed = replies._packed(chunks, "request_id", "seq", "at").collect()
    got = [(r["request_id"], r["at"].timestamp(), r["seqs"], r["tokens"], r["until"], r["error"]) for r in packed]
    got.sort(key=lambda g: g[:2])
    assert [g for g in got if g[0] == 1] == [
        (1, 49.0, list(range(50)), [f"w{i}" for i in range(50)], None, None), (1, 50.0, None, None, 50, "boom")]
    assert [g for g in got if g[0] == 3] == [(3, 0.0, [0], [""], None, None)]
    assert [g[1:] for g in got if g[0] == 2 and g[2] is None] == [(0.0, None, None, None, None), (1.0, None, None, 1, None)]
