"""Label-list parsing."""

import os

from fixtures import LABEL_FILE, PORTS

from portmart.sources.labels import label_lists, label_table, read_label_lines, read_label_table, visa_table, with_line_numbers


def _write(tmp_out, text, name="labels.SAS"):
    path = os.path.join(tmp_out, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_port_section_parsed_in_file_order(spark, tmp_out):
    rows = read_label_table(spark, _write(tmp_out, LABEL_FILE)).orderBy("ord").collect()
    assert [(r.code, r.label) for r in rows] == PORTS
    ords = [r.ord for r in rows]
    assert ords == sorted(ords) and len(set(ords)) == len(ords)


def test_other_sections(spark, tmp_out):
    lines = read_label_lines(spark, _write(tmp_out, LABEL_FILE))
    countries = label_table(lines, "i94cntyl").orderBy("ord").collect()
    assert [(r.code, r.label) for r in countries] == [
        ("582", "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)"),
        ("236", "AFGHANISTAN"),
        ("996", "No Country Code (996)"),  # entry on the closing line
    ]
    modes = label_table(lines, "i94model").collect()
    assert sorted((r.code, r.label) for r in modes) == [("1", "Air"), ("9", "Not reported")]
    assert label_table(lines, "nosuchsection").count() == 0


def test_line_numbers_follow_file_order_across_files(spark, tmp_out):
    folder = os.path.join(tmp_out, "many")
    os.makedirs(folder)
    lines = LABEL_FILE.splitlines()
    # Split the text over files of very different sizes: the scan sorts
    # splits by size, line numbers must still follow name order.
    cuts = [0, 3, 20, 21, len(lines)]
    for i in range(len(cuts) - 1):
        _write(folder, "\n".join(lines[cuts[i] : cuts[i + 1]]) + "\n", f"part-{i:05d}.txt")
    read = read_label_lines(spark, folder)
    got = with_line_numbers(read).orderBy("line_no").collect()
    assert [r.line_no for r in got] == list(range(1, len(lines) + 1))
    assert [r.value for r in got] == lines
    rows = label_table(read).orderBy("ord").collect()
    assert [(r.code, r.label) for r in rows] == PORTS


def test_lines_survive_another_split_size_while_they_are_used(spark, tmp_out):
    body = "".join(f"   'P{i:05d}'\t=\t'PORT {i}'\n" for i in range(5000))
    lines = read_label_lines(spark, _write(tmp_out, "  value $i94prtl\n" + body + ";\n"))
    entries = label_table(lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        counts = []
        for size in ("4k", "64k", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            rows = entries.orderBy("ord").collect()
            counts.append([(r.code, r.label) for r in rows])
            assert with_line_numbers(lines).agg({"line_no": "max"}).first()[0] == 5002
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert counts == [[(f"P{i:05d}", f"PORT {i}") for i in range(5000)]] * 3


def test_visa_list_in_a_comment(spark, tmp_out):
    text = "/* I94BIR - Age */\n/* I94VISA - Visa codes collapsed:\n   1 = Business\n   2 = Pleasure\n   3 = Student\n*/\n   4 = no\n"
    rows = visa_table(read_label_lines(spark, _write(tmp_out, text))).orderBy("ord").collect()
    assert [(r.code, r.label) for r in rows] == [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]


MANY = """/* I94VISA - Visa codes collapsed:
   1 = Business
   2 = Pleasure */
  value $one
   'A' = 'first; still open'
   'B' = 'it''s  '
   'C' = 'last' ;
   'D' = 'in no list'
  value two
   7 = 'seven'
   8 = 'eight'
;
  value $one
   'E' = 'of a second list of that name'
;
  value Three ;
   3 = 'after a head with its own end'
;
  value nothing
;
  value open
   1 = 'to the end of the text'
"""


def _entries(df):
    return [(r.code, r.label) for r in df.orderBy("ord").collect()]


def _same_lists(lines, names):
    got = label_lists(lines).persist()
    assert {r.section for r in got.select("section").distinct().collect()} <= set(names) | {"i94visa"}
    for name in names:
        assert _entries(got.where(got["section"] == name)) == _entries(label_table(lines, name)), name
    assert _entries(got.where(got["section"] == "i94visa")) == _entries(visa_table(lines))
    got.unpersist()
    return got


def test_all_lists_in_one_pass_equal_each_by_itself(spark, tmp_out):
    names = ["$one", "two", "three", "nothing", "open"]
    folder = os.path.join(tmp_out, "lists")
    os.makedirs(folder)
    text = MANY.splitlines(keepends=True)
    for i, at in enumerate(range(0, len(text), 5)):  # lists go on in the next file
        _write(folder, "".join(text[at : at + 5]), f"part-{i:05d}.txt")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "100"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            _same_lists(read_label_lines(spark, folder), names)
            _same_lists(read_label_lines(spark, _write(tmp_out, LABEL_FILE)), ["$i94prtl", "i94cntyl", "i94model"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_lists(spark, tmp_out):
    assert label_lists(read_label_lines(spark, _write(tmp_out, ""))).count() == 0
    assert label_lists(read_label_lines(spark, _write(tmp_out, "plain\n 'A' = 'x'\n", "other.SAS"))).count() == 0
