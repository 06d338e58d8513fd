"""The stateful line parser against the state machine in plain Python."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from plumbline.sources import readers


def plain(lines):
    code = college = location = last = None
    pending, out = "", []
    for at, line in lines:
        m = re.match(r"^\s*(\d{4})?\s*(.*?)\(((?:浙江|北京)[^()]*)\)(.*)$", line, re.A)
        rest = line
        named = bool(m and m[2].strip(" "))
        if named:
            college, location, rest, pending = m[2].strip(" "), m[3], m[4].strip(" "), ""
            code = m[1] or code
        cut = re.match(r"^(.*?)((?:\s\d+)*)$", rest, re.A)
        name, numbers = cut[1].strip(" "), [int(x) for x in cut[2].split()]
        if named and not name and not numbers:
            continue
        if numbers:
            last = [at, code, college, location, (pending + name).strip(), numbers]
            out.append(last)
            pending = ""
        elif name and len(name) <= 3 and last is not None and not pending:
            last[4] += name
        elif name:
            pending += name
    return [tuple([*r[:5], tuple(r[5])]) for r in out]


def test_line_parser_matches_the_state_machine(spark):
    draw = random.Random(1)
    bits = ["1234 College(浙江杭州)", "Other(北京)", "5678Third(浙江) name 5 6", "(浙江)", "a name", "ab", "x", "", "long part", "name 12 3 4", " 7", "部", "分 8", "0001 C(北京海淀) tail"]
    rows = [(doc, i, draw.choice(bits)) for doc in ["a", "b", None, "c"] for i in range(400)] + [("d", 1, "only text"), ("e", 1, "x 1")]
    df = spark.createDataFrame(rows, "doc string, no int, line string").repartition(5)
    want = Counter((doc, *r) for doc in ["a", "b", None, "c", "d", "e"] for r in plain([(i, t) for d, i, t in rows if d == doc]))
    got = readers.parse_records(df, ["浙江", "北京"], "doc", ["no"])
    assert got.columns == ["doc", "no", "code", "college", "location", "name", "numbers"]
    assert Counter((r.doc, r.no, r.code, r.college, r.location, r.name, tuple(r.numbers)) for r in got.collect()) == want and sum(want.values()) > 200
    assert readers.parse_records(df.where("false"), ["浙江"], "doc", ["no"]).count() == 0


def test_one_document_of_many_lines(spark):
    lines = spark.range(0, 200_000, 1, 8).select(F.lit("doc").alias("doc"), F.col("id").alias("no"), F.when(F.col("id") % 1000 == 0, F.concat(F.lit("College "), F.col("id").cast("string"), F.lit("(浙江)"))).when(F.col("id") % 3 == 1, "a longer name ").otherwise("end 1 2").alias("line"))
    got = readers.parse_records(lines, ["浙江"], "doc", ["no"])
    assert got.agg(F.count(F.lit(1)), F.count_distinct("college"), F.sum(F.length("name"))).first()[:2] == (lines.where("line = 'end 1 2'").count(), 200)
