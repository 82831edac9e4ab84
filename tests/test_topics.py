"""Golden rows for the batch report: reading, splitting, filtering, top-k, JSON."""

import json
import os

from pyspark.sql import functions as F

import gkg_fixture as fx
from topicscope.functions.text import java_split, split_all
from topicscope.operators.topics import (as_json_lines, daily_top_topics, nest_by_day,
                                         top_k_per_group, topic_day_counts, topic_mentions)
from topicscope.plans.daily_job import daily_report, run
from topicscope.sources.gkg import gkg_line_records, gkg_records, read_gkg, read_lines


def _counts(df):
    return {(str(r["day"]), r["topic"], r["count"]) for r in df.collect()}


def test_typed_scan_defaults(spark, scratch):
    path = fx.write(os.path.join(scratch, "eight.csv"))
    recs = gkg_records(read_gkg(spark, path))
    assert recs.count() == 5          # rows 2 (empty), 3 (bad date), 4 (short) dropped
    counts = topic_day_counts(topic_mentions(recs))
    assert _counts(counts) == fx.EXPECTED_COUNTS


def test_json_report(spark, scratch):
    path = fx.write(os.path.join(scratch, "eight.csv"))
    lines = [r["json"] for r in as_json_lines(daily_report(spark, path)).orderBy("json").collect()]
    assert lines == fx.EXPECTED_JSON
    out = os.path.join(scratch, "out")
    run(spark, path, out)
    written = sorted(json.dumps(json.loads(r["value"]), separators=(",", ":"))
                     for r in spark.read.text(out).collect())
    assert written == sorted(json.dumps(json.loads(x), separators=(",", ":"))
                             for x in fx.EXPECTED_JSON)


def test_contains_and_blank_options(spark, scratch):
    recs = gkg_records(read_gkg(spark, fx.write(os.path.join(scratch, "e.csv"))))
    contains = _counts(topic_day_counts(topic_mentions(recs, match="contains")))
    assert ("2015-02-20", "Sub Type ParentCategory X", 1) not in contains
    assert len(contains) == len(fx.EXPECTED_COUNTS) - 1
    no_blank = _counts(topic_day_counts(topic_mentions(recs, drop_blank=True)))
    assert no_blank == fx.EXPECTED_COUNTS - {("2015-02-19", "", 1)}


def test_default_quote_corrupts_open_quote_row(spark, scratch):
    path = fx.write(os.path.join(scratch, "q.csv"))
    quoted = read_gkg(spark, path, quote='"').where(F.col("GKGRECORDID") == "20150220001500-6")
    row = quoted.select("AllNames").first()
    assert row is None or row["AllNames"] != '"Open quote,4'


def test_line_scan(spark, scratch):
    path = fx.write(os.path.join(scratch, "l.csv"))
    recs = gkg_line_records(read_lines(spark, path))
    got = {(r["day"], r["all_names"]) for r in recs.collect()}
    # the short row and the 7-character bad date (position slicing needs 8) are
    # dropped; the row with an empty list passes the arity test because of Extras
    assert ("2015-02-19", "Alice Bob,12;Type ParentCategory,3;Carol,9;") in got
    assert ("2015-02-20", "") in got
    assert not any(d.startswith("badd") for d, _ in got)
    assert len(got) == 6


def test_ties(spark):
    rows = [("d", c, 2) for c in "abcdefghi"] + [("d", c, 1) for c in "jkl"]
    counts = spark.createDataFrame(rows, "day string, topic string, count long")
    inc = top_k_per_group(counts, k=10, ties="include").collect()
    cut = top_k_per_group(counts, k=10, ties="cut").collect()
    assert len(inc) == 12
    assert len(cut) == 10 and {r["topic"] for r in cut} == set("abcdefghij")
    nested = nest_by_day(top_k_per_group(counts, k=10, ties="cut")).first()
    assert [e["topic"] for e in nested["result"]] == list("abcdefghij")


def test_split_forms(spark):
    df = spark.createDataFrame([(x,) for x in ["", ";", ";;a", "a;;b;;"]], "s string")
    got = {r["s"]: (list(r["j"]), list(r["a"]))
           for r in df.select("s", java_split("s").alias("j"), split_all("s").alias("a")).collect()}
    assert got[""] == ([""], [""])
    assert got[";"] == ([], ["", ""])
    assert got[";;a"] == (["", "", "a"], ["", "", "a"])
    assert got["a;;b;;"] == (["a", "", "b"], ["a", "", "b", "", ""])


def test_trailing_newline_is_not_a_separator(spark):
    df = spark.createDataFrame([("a..\n",), ("x..",)], "s string")
    got = [list(r[0]) for r in df.select(java_split("s", ".")).collect()]
    assert got == [["a", "", "\n"], ["x"]]


def test_exact_top_is_subset_of_ties(spark):
    from conftest import SF_SMALL
    from topicscope.sources.gkg import gkg_like
    recs = gkg_like(spark, SF_SMALL)
    inc = {tuple(r) for r in daily_top_topics(recs, ties="include").collect()}
    cut = {tuple(r) for r in daily_top_topics(recs, ties="cut").collect()}
    assert cut <= inc
    mentions = topic_mentions(recs).count()
    assert topic_day_counts(topic_mentions(recs)).agg(F.sum("count")).first()[0] == mentions


def test_tolerant_decode(spark, scratch):
    path = os.path.join(scratch, "bad.txt")
    with open(path, "wb") as f:
        f.write(b"ab\xffcd\tx\n" + "été\n".encode())
    got = [r["value"] for r in read_lines(spark, path).collect()]
    assert got == ["abcd\tx", "été"]


def test_top_k_array(spark):
    from topicscope.operators.topics import top_k_array
    rows = [("d", c, n) for c, n in zip("abcdefghijkl", range(12, 0, -1))]
    nested = nest_by_day(spark.createDataFrame(rows, "day string, topic string, count long"))
    first = nested.select(top_k_array("result", 10).alias("r")).first()["r"]
    assert [e["topic"] for e in first] == list("abcdefghij")


def test_count_fields_matches_split(spark):
    from topicscope.functions.text import count_fields, nth_field
    vals = ["", "\t", "a", "a\t", "\ta", "a\t\tb\t\t", "a\tb\tc", "\t\t\t"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select("v", count_fields("v").alias("n"), F.size(java_split("v", "\t")).alias("m"),
                     nth_field("v", 1).alias("f1")).collect()
    for r in rows:
        assert r["n"] == r["m"], r
    assert {r["v"]: r["f1"] for r in rows}["a\tb\tc"] == "b"


def test_line_reader_report(spark, scratch):
    path = fx.write(os.path.join(scratch, "r.csv"))
    rep = daily_report(spark, path, reader="lines", ties="cut", match="contains")
    got = {r["data"]: [(e["topic"], e["count"]) for e in r["result"]] for r in rep.collect()}
    assert got["2015-02-19"] == [("Alice Bob", 2), ("", 1), ("Carol", 1), ("World War ", 1)]
    # the empty list of row 2 becomes one blank topic; the substring match drops "Sub ..."
    assert got["2015-02-20"] == [('Quote" x', 2), ("", 1), ('"Open quote', 1), ("Alice Bob", 1),
                                 ('He said "hi', 1)]


def test_size_shuffle_only_raises(spark, scratch):
    from topicscope.session import input_bytes, size_shuffle
    path = fx.write(os.path.join(scratch, "s.csv"))
    assert input_bytes(spark, path) == os.path.getsize(path)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    n = size_shuffle(spark, [path])
    assert n >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert size_shuffle(spark, [path], shuffle_fraction=1.0, target_bytes=1) >= os.path.getsize(path)
    if before is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, before)


def test_size_scan_raises_within_bounds(spark, scratch):
    from topicscope.session import size_scan
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    path = fx.write(os.path.join(scratch, "s.csv"))
    cores = spark.sparkContext.defaultParallelism
    try:
        spark.conf.set(key, "128MB")
        assert size_scan(spark, [path]) == 128 << 20            # small input: default kept
        # 100 TB over this session's cores: capped at 1 GB per task
        assert size_scan(spark, [path], total_bytes=100 << 40) == 1 << 30
        assert spark.conf.get(key) == str(1 << 30)
        assert size_scan(spark, [path], total_bytes=0) == 1 << 30   # never lowered
        spark.conf.set(key, "128MB")
        mid = cores * 4 * (300 << 20)
        assert size_scan(spark, [path], total_bytes=mid) == 300 << 20
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def test_typed_and_line_readers_agree_on_clean_records(spark):
    from conftest import SF_SMALL
    from topicscope.sources.gkg import gkg_tsv_path
    path = gkg_tsv_path(spark, SF_SMALL)
    typed = topic_day_counts(topic_mentions(gkg_records(read_gkg(spark, path))))
    lines = topic_day_counts(topic_mentions(gkg_line_records(read_lines(spark, path)),
                                            match="contains"))
    typed = typed.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "topic", "count")
    assert typed.count() == lines.count() > 0
    assert typed.exceptAll(lines).count() == 0


def test_daily_job_command_line(scratch):
    """The batch program as a user runs it: input files and an output folder
    on the command line, both readers, in a process of its own."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = fx.write(os.path.join(scratch, "in.csv"))
    env = dict(os.environ, PYTHONPATH=root + os.pathsep + os.environ.get("PYTHONPATH", ""))
    outs = {}
    for reader in ("typed", "lines"):
        out = os.path.join(scratch, f"out_{reader}")
        subprocess.run([sys.executable, "-m", "topicscope.plans.daily_job", path, out,
                        "--reader", reader], check=True, env=env, cwd=scratch, timeout=600,
                       capture_output=True)
        rows = []
        for name in sorted(os.listdir(out)):
            if name.startswith("part-"):
                with open(os.path.join(out, name), encoding="utf-8") as f:
                    rows += [json.loads(x) for x in f if x.strip()]
        outs[reader] = {r["data"]: [(e["topic"], e["count"]) for e in r["result"]] for r in rows}
    want = {json.loads(x)["data"]: [(e["topic"], e["count"]) for e in json.loads(x)["result"]]
            for x in fx.EXPECTED_JSON}
    assert outs["typed"] == want
    # line rules: substring stop topic, an empty list is one blank topic
    assert outs["lines"]["2015-02-19"] == want["2015-02-19"]
    assert outs["lines"]["2015-02-20"] == [('Quote" x', 2), ("", 1), ('"Open quote', 1),
                                           ("Alice Bob", 1), ('He said "hi', 1)]


def test_has_fields_matches_split_keeping_empties(spark):
    from topicscope.functions.text import has_fields
    lines = ["", "a", "a\tb", "\t" * 22, "\t" * 23, "x\t" * 23 + "y", "a\t\t", None]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    for n in (1, 2, 3, 23, 24, 25):
        got = [r[0] for r in df.select(has_fields("v", n)).collect()]
        want = [r[0] for r in df.select(F.size(F.split("v", "\t", -1)) >= n).collect()]
        assert [bool(g) for g in got] == [bool(w) for w in want], n


def test_line_rule_without_counting_every_field(spark):
    """has_fields on the line without its trailing tabs keeps exactly the
    lines that count_fields (String.split rule) keeps."""
    from topicscope.functions.text import count_fields, has_fields
    lines = ["", "\t\t", "a", "a\t\t", "\t" * 23 + "x", "x\t" * 23, "x\t" * 24,
             "y\t" * 30 + "\t\t", "a\t" * 10 + "\t" * 20]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    body = F.rtrim("v", F.lit("\t"))
    for n in (2, 3, 24, 25):
        got = [bool(r[0]) for r in df.select(has_fields(body, n)).collect()]
        want = [bool(r[0]) for r in df.select(count_fields("v") >= n).collect()]
        assert got == want, n
