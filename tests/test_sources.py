import os
import tempfile

import pytest

from tabulary.sources.csv import DOSAGE_FORM, MEDICINE, read_source
from tabulary.sources.sinks import schema_report, write_table


def test_read_csv_with_bom_quotes_and_empty_fields(spark):
    folder = tempfile.mkdtemp(prefix="tabulary-csv-")
    plain = os.path.join(folder, "Dosage_Form.csv")
    with open(plain, "w", encoding="utf-8") as f:
        f.write("﻿Dosage_Form_ID,Dosage_Form_Name,Slug,Brand_Names_Count\n")
        f.write("1,Tablet,tablet,10\n2,,blank,\n")
    quoted = os.path.join(folder, "Medicine.csv")
    with open(quoted, "w", encoding="utf-8") as f:
        f.write("Brand_ID,Brand_Name,Type,Slug,Dosage_Form,Generic,Strength,Manufacturer,"
                "Package_Container,Package_Size\n")
        f.write('1,"Napa ""Extra""",allopathic,napa,Tablet,Paracetamol,500 mg,Beximco,'
                '"25 ml jar: ৳ 70.00,80 ml jar: ৳ 210.00","(6\'s pack: ৳ 31.00)"\n')
    d = read_source(spark, plain, DOSAGE_FORM, quoted=False).collect()
    assert [tuple(r) for r in d] == [(1, "Tablet", "tablet", 10), (2, None, "blank", None)]
    m = read_source(spark, quoted, MEDICINE).first()
    assert m.Brand_Name == 'Napa "Extra"'
    assert m.Package_Container == "25 ml jar: ৳ 70.00,80 ml jar: ৳ 210.00"


def _file(name, text):
    path = os.path.join(tempfile.mkdtemp(prefix="tabulary-csv-"), name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


HEAD = "Dosage_Form_ID,Dosage_Form_Name,Slug,Brand_Names_Count\n"


@pytest.mark.parametrize("row", ["1,Gel,gel,4,surplus", "one,Gel,gel,4"])
def test_bad_rows_fail_unless_permitted(spark, row):
    path = _file("Dosage_Form.csv", HEAD + "2,Pill,pill,1\n" + row + "\n")
    with pytest.raises(Exception, match="(?i)malformed|bad record|FAILFAST"):
        read_source(spark, path, DOSAGE_FORM, quoted=False).collect()
    assert read_source(spark, path, DOSAGE_FORM, quoted=False, bad_rows="PERMISSIVE").count() == 2


def test_line_breaks_in_quoted_fields(spark):
    path = _file("Dosage_Form.csv", HEAD + '1,"Gel,\nsmall",gel,4\n2,Pill,pill,1\n')
    got = read_source(spark, path, DOSAGE_FORM).collect()
    assert [r.Dosage_Form_Name for r in got] == ["Gel,\nsmall", "Pill"]


def test_write_table_observes_count_and_overwrites(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="tabulary-out-"), "t")
    assert write_table(spark.range(7), out) == 7
    assert write_table(spark.range(3), out) == 3
    assert spark.read.parquet(out).count() == 3


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    assert schema_report(df, "t") == [("t", "id", "bigint", "YES"), ("t", "name", "string", "YES")]
