"""Column expressions against Python's own rules."""

from __future__ import annotations

import random
import re
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from mailsift.functions import naming
from mailsift.functions.formats import DEFAULT, detect_format, file_type, is_supported, skip_reason


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression.alias("o")).first().o


@pytest.mark.parametrize(
    "name, fmt",
    [
        ("a.eml", "eml"),
        ("a.html", "html"),
        ("a.htm", "html"),
        ("a.msg", "msg"),
        ("a.mbox", "mbox"),
        ("a.pst", "pst"),
        ("a.zip", "zip"),
        ("A.EmL", "eml"),
        ("a.png", "unknown"),
        ("eml", "unknown"),
        ("", "unknown"),
        ("a.eml\n", "unknown"),
        ("a.eml.bak", "unknown"),
    ],
)
def test_formats(spark, name, fmt):
    assert one(spark, name, detect_format("v")) == fmt
    known = DEFAULT.of(name)
    assert (known.name if known else "unknown") == fmt


def test_classes_and_reasons(spark):
    rows = spark.createDataFrame(
        [(f,) for f in ("eml", "html", "msg", "mbox", "pst", "zip", "unknown")], "f string"
    ).select("f", file_type("f").alias("t"), is_supported("f").alias("s"), skip_reason(F.col("f")).alias("r"))
    got = {r.f: (r.t, r.s, r.r) for r in rows.collect()}
    assert got["eml"][:2] == got["html"][:2] == ("single_email", True)
    assert got["zip"][:2] == got["mbox"][:2] == ("container", True)
    assert got["msg"] == ("unknown", False, "msg_not_supported")
    assert got["pst"] == ("unknown", False, "pst_not_supported")
    assert got["unknown"] == ("unknown", False, "unsupported_format")


def test_registered_suffix_is_seen_by_both_sides(spark):
    own = DEFAULT.register(".tar.eml", "single_email", name="tarmail")
    assert own.of("x.TAR.eml").name == one(spark, "x.TAR.eml", own.detect(F.col("v"))) == "tarmail"
    assert own.of("x.eml").name == one(spark, "x.eml", own.detect(F.col("v"))) == "eml"
    with pytest.raises(ValueError):
        DEFAULT.register(".rar", "container")


def test_message_id_names_follow_word_characters_of_all_scripts(spark):
    rng = random.Random(3)
    ids = ["<a@b.c>", "<<x>>", "plain", "<a b\n c@d>", "<" + "x" * 150 + ">", "é²‿_½़"]
    ids += ["".join(chr(rng.randrange(32, 0x3000)) for _ in range(30)) for _ in range(300)]
    ids = [i for i in ids if i.isprintable() or "\n" in i]
    got = {
        r.v: r.o
        for r in spark.createDataFrame([(i,) for i in ids], "v string")
        .select("v", naming.safe_message_id(F.col("v")).alias("o"))
        .collect()
    }
    for text in ids:
        assert got[text] == re.sub(r"[^\w.@-]", "_", text.strip("<>"))[:100]


def test_suffixes_follow_path_rules(spark):
    names = ["a.eml", "A.HTML", "a", ".eml", "..eml", "a.", "d.x/a", "d/a.tar.gz", "a b.é", "a..b", "x/.hid", "a\n.htm"]
    got = {
        r.v: r.o
        for r in spark.createDataFrame([(n,) for n in names], "v string")
        .select("v", naming.suffix_of(F.col("v")).alias("o"))
        .collect()
    }
    for name in names:
        assert got[name] == (PurePosixPath(name).suffix or ".eml"), name


def test_attachment_names_stay_inside_and_apart(spark):
    rows = [(0, "../../etc/passwd"), (1, "a.pdf"), (0, "001-a.pdf"), (2, "C:\\x\\y.txt"), (0, ".."), (1, ""), (0, "t\x00.txt")]
    got = [
        r.o
        for r in spark.createDataFrame(rows, "n int, v string")
        .select(naming.safe_attachment_name(F.col("v"), F.col("n")).alias("o"))
        .collect()
    ]
    assert got == ["passwd", "001-a.pdf", "000-001-a.pdf", "002-y.txt", "attachment", "001-attachment", "t_.txt"]


def test_skip_path_names_each_step_once(spark):
    path = naming.skip_path(F.lit("ns"), F.lit("2024-07-15"), F.lit("a.zip"), F.array(F.lit("b.zip"), F.lit("x.png")))
    assert one(spark, "", path) == "ns/timestamp=2024-07-15/a.zip/b.zip/x.png"
