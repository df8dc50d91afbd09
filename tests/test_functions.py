import datetime

import pytest
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerline import functions as G


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = rows.select("i", rule(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(out)]


def check(spark, rule, cases):
    assert apply(spark, rule, list(cases)) == list(cases.values())


def test_dates(spark):
    day = datetime.date
    check(spark, G.normalize_date, {
        "20240229": day(2024, 2, 29),
        "20240231": None,
        "2024/1/5 8:05:00": day(2024, 1, 5),
        "2024/1/5": day(2024, 1, 5),
        "2024-1-5 8": day(2024, 1, 5),
        "2024-1-5 later": None,
        "2024-01-05T10:00:00Z": day(2024, 1, 5),
        "2024-02-30": None,
        "0000-00-00": None,
        "0000-00-00 00:00:00": None,
        "1700000000": day(2023, 11, 14),
        "1700000000123": day(2023, 11, 14),
        "  2024-01-05 ": day(2024, 1, 5),
        "12": None,
        "": None,
        "   ": None,
        None: None,
        "n/a": None,
        "2024": None,
        "2024-01": None,
        "20240105x": None,
    })


def test_lists(spark):
    check(spark, G.multi_value, {
        "a , b;c": "a;b;c", "a　;b": "a;b", "a; b": "a;b", " ": None, "": None,
        None: None, "a b ; c d": "a b;c d", "a ; ; b": "a;;b", ";": ";", "x\t;y": "x;y",
        "x%y": "x%y", " plain ": "plain",
    })
    check(spark, lambda c: G.multi_value(c, also="%"), {"x%y": "x;y", "x, y%z ; w": "x;y;z;w"})


def test_lists_twice_is_once(spark):
    values = ["a , b;c", "a　;b", " ; ", "a;;b", "x,,y", None]
    once = apply(spark, G.multi_value, values)
    assert apply(spark, G.multi_value, once) == once


def test_numbers_and_flags(spark):
    check(spark, G.number_without_country, {
        " cn123.x ": "123.X", "CN": None, "us1CN": "US1CN", "": None, None: None,
    })
    check(spark, G.upper_or_null, {" cn1a": "CN1A", "  ": None, None: None})
    check(spark, G.fulltext_flag, {"1": 1, " 0 ": 0, "2": None, "": None, None: None})
    check(spark, G.year_of, {"2024年": "2024", "99": "99", None: None})
    check(spark, G.type_code, {"A01B1/00": "A01", " G0": "G0", " ": "UNK", None: "UNK"})
    check(spark, G.integer_text, {
        " 007.00 ": "7", "1.5": "1.5", "12.0": "12", " 00123.000 ": "123", "5": "5", "": "",
        None: None, "9" * 25 + ".0": "9" * 25 + ".0",
    })


def test_addresses(spark):
    check(spark, G.address_without_zip, {
        "100000 Beijing": "Beijing", "Beijing": "Beijing", None: None, "12345 X": "12345 X",
    })
    check(spark, G.zip_of_address, {"100000 Beijing": "100000", "Beijing": "", None: ""})
    check(spark, G.first_of_list, {"a;b": "a", ";b": "", " ": None, None: None, " a ": " a "})


def test_object_path(spark):
    base = F.lit("bucket/")
    check(spark, lambda c: G.object_path(base, c, "a"), {
        "files/1.pdf": "bucket/1.pdf", "FILES/1.pdf": "bucket/1.pdf",
        "pdf/files/1.pdf": "bucket/pdf/files/1.pdf", " ": None, None: None,
    })
    check(spark, lambda c: G.object_path(base, c, "d"), {"files/1.pdf": "bucket/files/1.pdf"})


def test_reasons(spark):
    check(spark, lambda c: G.append_reason(c, "m"), {
        None: "m", "": "m", "a": "a;m", "a;m": "a;m", "  ": "m",
    })


@pytest.mark.parametrize("patent_id,fulltext,file,flag,reason", [
    ("P1", "", "x", 1, "hasfulltext为0或为空"),
    ("P1", "2", None, 0, ""),
    ("P1", "1", "x", 1, ""),
    ("P1", "1", " ", 1, "hasfulltext是1但publish_file为空"),
    ("P1", " 0 ", "x", 1, "hasfulltext为0或为空"),
    ("P1", "0", "x", 0, "hasfulltext为0或为空"),
    (" ", None, None, 0, "patent_id为空;hasfulltext为0或为空"),
    (None, "1", None, 0, "patent_id为空;hasfulltext是1但publish_file为空"),
])
def test_validity(spark, patent_id, fulltext, file, flag, reason):
    row = spark.createDataFrame([(patent_id, fulltext, file)], "a string, b string, c string")
    test = [F.col(c) for c in "abc"]
    found = row.select(G.validity_flag(*test), G.validity_reason(*test)).first()
    assert tuple(found) == (flag, reason)


def test_file_size(spark):
    assert apply(spark, G.megabytes, [1048576.0, 1500000.0, None], "double") == [1.0, 1.431, None]


# ---- classification paths ----


def pruned(text):
    """The rule told in plain Python."""
    parts = [p.strip() for p in text.split("$$$")]
    best = {}
    for place, part in enumerate(p for p in parts if p):
        head = part.split(">")[0].strip()
        code = head.split("^")[0].strip()
        section = code[:1] or head or part
        rank = (part.count(">"), len(part), -place)
        if section not in best or rank > best[section][0]:
            first = best[section][1] if section in best else place
            best[section] = (rank, first, part)
    return "$$$".join(part for _, _, part in sorted(best.values(), key=lambda b: b[1]))


PATHS = {
    "A^农业>A01^农林>A01B^整地$$$A^农业>A01^农林$$$G^物理": "A^农业>A01^农林>A01B^整地$$$G^物理",
    "G06F^计算$$$A01B^整地>x$$$G06N^计算模型": "G06N^计算模型$$$A01B^整地>x",
    " E05B^锁 $$$ $$$E05C^门闩>y ": "E05C^门闩>y",
    ">abc$$$^x>y$$$>abc>d": ">abc$$$^x>y$$$>abc>d",
}


def test_paths(spark):
    check(spark, G.prune_paths, {**PATHS, "": "", " $$$ ": "", None: None})


def test_path_rule_keeps_the_old_value(spark):
    def rule(flag, **how):
        return lambda c: G.clean_path(c, F.lit(flag), **how)

    check(spark, rule(1), {
        " A^x>B ": " A^x>B ", "plain": "plain", "": "", None: None, " $$$ ": " $$$ ",
        "A>b$$$A": "A>b",
    })
    check(spark, rule(0), {"A>b$$$A": "A>b$$$A"})
    check(spark, rule(1, guarded=False), {" A^x>B ": "A^x>B", " $$$ ": "", "plain": "plain"})


pieces = st.lists(
    st.sampled_from(["A", "a", "G06", "^", ">", "$$$", "$", " ", "　", "农", "x>y", "^^", "\t"]),
    max_size=14,
).map("".join)


@settings(max_examples=15, deadline=None, phases=[Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pieces, min_size=20, max_size=60))
def test_paths_like_the_plain_rule(spark, values):
    assert apply(spark, G.prune_paths, values) == [pruned(v) for v in values]
    # A part that begins or ends with a lone $ joins up with the separator.
    once = [p for p in map(pruned, values) if "$" not in p.replace("$$$", "")]
    once = [p for p in once if "$$$$" not in p]
    assert apply(spark, G.prune_paths, once) == once
