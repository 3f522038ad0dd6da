"""Folder source (FIXTURES 4), sinks, and stream = batch."""

import json
import os
import pickle
import tempfile
import tracemalloc

from mailspark.config import VectorizerConfig
from mailspark.plans.score import score_folders
from mailspark.plans.train import fit_text_model, score_docs
from mailspark.sources import mail_format
from mailspark.sources.folders import read_labelled_folders, read_mail_folder, write_mail_folder
from mailspark.sources.mail_format import MailStream, slices
from mailspark.sources.sinks import write_prediction_lines
from mailspark.sources.tables import labelled_docs
from mailspark.streaming.score_stream import mail_folder_stream, read_scores, start_scoring


def make_folder():
    d = tempfile.mkdtemp(prefix="mailspark-folder-")
    files = {
        "0006.2003-12-18.GP.spam.txt": "Free MONEY now!\\nclick",
        "empty.txt": "",
        "_u.txt": "hidden",
        ".h.txt": "hidden",
        "UP.TXT": "upper",
        "n.md": "markdown",
    }
    for name, body in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(body)
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "in.txt"), "w") as f:
        f.write("nested")
    return d


def test_folder_source(spark):
    d = make_folder()
    rows = {r["file_name"]: r for r in read_mail_folder(spark, d, "spam").collect()}
    assert set(rows) == {"0006.2003-12-18.GP.spam.txt", "empty.txt"}
    r = rows["0006.2003-12-18.GP.spam.txt"]
    assert r["sender"] == "GP" and str(r["sent_date"]) == "2003-12-18" and r["label"] == "spam"
    assert rows["empty.txt"]["text"] == "" and rows["empty.txt"]["sender"] == "ezezaguna"


def test_missing_folder(spark):
    assert read_mail_folder(spark, "/nonexistent/mailspark/x", "ham").count() == 0
    both = read_labelled_folders(spark, "/nonexistent/a", make_folder())
    assert both.count() == 2


def test_score_folders_and_lines(spark):
    d = make_folder()
    m = fit_text_model(labelled_docs(spark, "/root/testdata/sf0.001"), VectorizerConfig(words_to_keep=50), 1.0, 50)
    pred = score_folders(spark, [d, "/nonexistent/y"], m)
    assert pred.count() == 2  # the empty mail is scored too (F5)
    out = tempfile.mkdtemp(prefix="mailspark-lines-") + "/lines"
    write_prediction_lines(pred, out)
    lines = sorted(r["value"] for r in spark.read.text(out).collect())
    assert any(l.endswith(', "0006.2003-12-18.GP.spam.txt"') for l in lines)
    assert all(l.split(", ")[0] in ("ham", "spam") for l in lines)


def test_stream_equals_batch(spark):
    d = make_folder()
    m = fit_text_model(labelled_docs(spark, "/root/testdata/sf0.001"), VectorizerConfig(words_to_keep=50), 1.0, 50)
    out = tempfile.mkdtemp(prefix="mailspark-stream-") + "/out"
    q = start_scoring(mail_folder_stream(spark, d), m, out, keep=("doc_id", "file_name"), available_now=True)
    q.awaitTermination()
    streamed = {r["file_name"]: r["probability"] for r in spark.read.parquet(out).collect()}
    batch = {r["file_name"]: r["probability"] for r in score_folders(spark, [d], m).collect()}
    assert streamed == batch and set(streamed) == {"0006.2003-12-18.GP.spam.txt", "empty.txt"}


def test_mails_are_read_in_slices(spark):
    d = tempfile.mkdtemp(prefix="mailspark-slices-")
    for i in range(25):
        with open(f"{d}/m{i:02d}.txt", "wb") as f:
            f.write([b"", "ñandú 漢字".encode(), b"bad \xff byte"][i % 3])
    read = spark.read.format("mails").option("filesPerSlice", 10).load(d)
    assert read.rdd.getNumPartitions() == 3
    got = {r["file_name"]: r["text"] for r in read.collect()}
    assert got == {f"m{i:02d}.txt": ["", "ñandú 漢字", "bad \ufffd byte"][i % 3] for i in range(25)}
    assert {r["doc_id"] for r in read_mail_folder(spark, "file://" + d).collect()} == {f"{d}/{n}" for n in got}
    assert [len(s.names) for s in slices([("a", 10), ("b", 100 << 20), ("c", 0)])] == [2, 1]


def test_written_mails_come_back(spark):
    rows = [(f"{i}.txt", t) for i, t in enumerate(["one", "", None, "two\r\nlines", "x" * 100_000])]
    d = tempfile.mkdtemp(prefix="mailspark-write-") + "/in/here"
    mails = spark.createDataFrame(rows, "file_name string, text string")
    write_mail_folder(mails.repartition(3), d)
    write_mail_folder(mails.limit(2), d)  # again: the same files
    assert {r["file_name"]: r["text"] for r in read_mail_folder(spark, d).collect()} == {n: t or "" for n, t in rows}


def test_stream_goes_on_after_a_stop(spark):
    """Files arrive while no query runs, with names before and after those seen; a stop leaves rows that are not committed."""
    root = tempfile.mkdtemp(prefix="mailspark-restart-")
    m = fit_text_model(labelled_docs(spark, "/root/testdata/sf0.001"), VectorizerConfig(words_to_keep=50), 1.0, 50)

    def arrive(names):
        write_mail_folder(spark.createDataFrame([(n, f"text of {n}" * (len(n) % 2)) for n in names], "file_name string, text string"), f"{root}/in")

    def run():
        stream = mail_folder_stream(spark, f"{root}/in", f"{root}/files")
        start_scoring(stream, m, f"{root}/out", keep=("file_name",), checkpoint=f"{root}/ckpt", available_now=True).awaitTermination()

    schema = "file_name string, margin double, probability double, prediction string"
    arrive(["m.txt", "n1.txt"])
    run()
    arrive(["a.txt", "z.txt", "m2.txt"])
    # a batch that was written but not committed
    read_scores(spark, f"{root}/out", schema).drop("batch_id").write.parquet(f"{root}/out/batch_id=7")
    assert {r["file_name"] for r in read_scores(spark, f"{root}/out", schema).collect()} == {"m.txt", "n1.txt"}
    run()
    run()  # nothing new
    got = sorted((r["file_name"], r["probability"]) for r in read_scores(spark, f"{root}/out").collect())
    assert got == sorted((r["file_name"], r["probability"]) for r in score_folders(spark, [f"{root}/in"], m).collect())
    assert read_scores(spark, f"{root}/none", schema).count() == 0


def test_stream_offsets_are_replayed(spark):
    d = make_folder()
    first = MailStream(d, d + "/log", 100)
    assert first.latestOffset() == {"n": 1} == first.latestOffset()
    with open(d + "/0.txt", "w") as f:
        f.write("late")
    again = MailStream(d, d + "/log", 100)  # after a restart
    names = lambda r, a, b: [n for s in r.partitions({"n": a}, {"n": b}) for n in s.names]
    assert names(again, 0, 1) == ["0006.2003-12-18.GP.spam.txt", "empty.txt"]
    assert again.latestOffset() == {"n": 2} and names(again, 1, 2) == ["0.txt"] and names(again, 2, 2) == []


def test_stream_keeps_no_names_in_memory(tmp_path, monkeypatch):
    """Listing, comparing and planning 40,000 mails takes less memory than their names would."""
    monkeypatch.setattr(mail_format, "RUN_NAMES", 500, raising=False)
    d, names = tmp_path / "in", [f"{i * 7919 % 40_000:05d}.2003-12-18.sender.spam.txt" for i in range(40_000)]
    d.mkdir()
    for n in names[:30_000]:
        (d / n).touch()
    made = MailStream(str(d), str(tmp_path / "log"), 1000)
    made.latestOffset(), made.partitions({"n": 0}, {"n": 1})  # imports and caches
    for n in names[30_000:]:
        (d / n).touch()
    tracemalloc.start()
    r = MailStream(str(d), str(tmp_path / "log"), 1000)
    assert r.latestOffset() == {"n": 2}
    parts = r.partitions({"n": 0}, {"n": 2})
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()
    assert len(pickle.dumps(parts)) < 10_000 and all(len(p.names) == 1000 for p in parts)
    assert [n for p in parts for n in p.names] == sorted(names[:30_000]) + sorted(names[30_000:])


def test_stream_goes_on_from_an_older_log(tmp_path):
    """Entries used to be one list each; odd names come through."""
    d, log = tmp_path / "in", tmp_path / "log"
    d.mkdir(), log.mkdir()
    for n in ("a.txt", "b\nc.txt", "ñ\"[[.txt", "z.txt"):
        (d / n).write_text(n)
    (log / "000000000001.json").write_text(json.dumps([["b\nc.txt", 7], ["z.txt", 5]]))
    r = MailStream(str(d), str(log), 1)
    assert r.latestOffset() == {"n": 2} == MailStream(str(d), str(log), 1).latestOffset()
    assert [s.names for s in r.partitions({"n": 0}, {"n": 2})] == [["b\nc.txt"], ["z.txt"], ["a.txt"], ["ñ\"[[.txt"]]
    assert MailStream(str(d), str(log), 3).partitions({"n": 0}, {"n": 2})[0].names == ["b\nc.txt", "z.txt", "a.txt"]
    assert [x for s in r.partitions({"n": 0}, {"n": 2}) for b in r.read(s) for x in b.column(2).to_pylist()] == ["b\nc.txt", "z.txt", "a.txt", "ñ\"[[.txt"]


def test_many_runs_of_names_are_merged(monkeypatch):
    monkeypatch.setattr(mail_format, "MOST_RUNS", 3)
    monkeypatch.setattr(mail_format, "RUN_NAMES", 2)
    names = mail_format.Names()
    names.add_unsorted(iter([(f"{i * 7 % 23:02d}", i) for i in range(23)]))
    assert [x[0] for x in names] == [f"{i:02d}" for i in range(23)] == [x[0] for x in names] and len(names.runs) <= 3
    assert list(mail_format.unseen([("a", 1), ("b", 2), ("d", 3)], [("a", 9), ("c", 1)])) == [("b", 2), ("d", 3)]
