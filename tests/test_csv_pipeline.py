"""The whole ETL from CSV files in the source layouts, through the command
line entry point: dimensions, backfill, lookups with misses, packed text,
junction, and the check report."""

import os
import tempfile

from tabulary.__main__ import main
from tabulary.plans.catalog import build_catalog
from tabulary.sources.csv import read_sources
from tabulary.sources.store import TableStore

NB = " "


def _write(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def _sources():
    d = tempfile.mkdtemp(prefix="tabulary-src-")
    _write(d, "Drug_Class.csv", "﻿Drug_Class_ID,Drug_Class_Name,Slug,Generics_Count\n"
           "1,Analgesic,analgesic,3\n2,Analgesic ,analgesic-b,1\n3,Antibiotic" + NB + ",antibiotic,2\n")
    _write(d, "Dosage_Form.csv", "Dosage_Form_ID,Dosage_Form_Name,Slug,Brand_Names_Count\n"
           "1,Tablet,tablet,10\n2,Syrup,syrup,4\n3,,blank,\n")
    _write(d, "Manufacturer.csv", "﻿Manufacturer_ID,Manufacturer_Name,Slug,Generics_Count,Brand_Names_Count\n"
           "1,Acme;Ltd,acme,2,\n2,Globex,globex,1,3\n")
    _write(d, "Indication.csv", "Indication_ID,Indication_Name,Slug,Generics_Count\n"
           "1,Fever,fever,2\n2,Cutaneous,cutaneous,1\n")
    _write(d, "Generic.csv", "Generic_ID,Generic_Name,Slug,Drug_Class,Indication\n"
           "1,Paracetamol,paracetamol,Analgesic,Fever\n"
           "2,Amoxicillin,amoxicillin,Antibiotic,\"CutaneousÂ" + NB + "\"\n"
           "3,Herbex,herbex,Herbal,Fever\n"
           "4,Blankclass,blankclass,,Fever\n")
    _write(d, "Medicine.csv",
           "Brand_ID,Brand_Name,Type,Slug,Dosage_Form,Generic,Strength,Manufacturer,Package_Container,Package_Size\n"
           "10,Napa,allopathic,napa,Tablet,Paracetamol,500 mg,Acme;Ltd,"
           "\"Unit Price: ৳ 1.20;(100's pack: ৳ 120.00);\",\"(100's pack: ৳ 120.00)\"\n"
           "11,Moxa,allopathic,moxa,Syrup,Amoxicillin,125 mg,Initech,"
           "\"100 ml bottle: ৳ 80.00;60 ml botttle: ৳ 1;050.00\",\n"
           "12,Herbo,herbal,herbo,Syrup,Herbex,5 ml,Globex,\"10 gm tube;15 gm tube\",\n")
    return d


def test_build_from_csv(spark):
    t = build_catalog(read_sources(spark, _sources()))
    dc = sorted((r.drug_class_id, r.drug_class_name, r.slug) for r in t["drug_class"].collect())
    assert dc == [(1, "Analgesic", "analgesic"), (2, "Antibiotic", "antibiotic"), (3, "Herbal", None)]
    assert t["dosage_form"].count() == 2
    assert sorted(r.manufacturer_name for r in t["manufacturer"].collect()) == ["Acme,Ltd", "Globex"]
    gen = {r.generic_name: r.drug_class_id for r in t["generic"].collect()}
    assert gen == {"Amoxicillin": 2, "Herbex": 3, "Paracetamol": 1}
    med = {r.brand_name: r for r in t["medicine"].collect()}
    assert med["Moxa"].manufacturer_id is None and med["Herbo"].manufacturer_id == 2
    assert med["Napa"].manufacturer_id == 1         # ';' read back as ',' on both sides
    cont = sorted((r.brand_id, r.container_size, str(r.unit_price), r.container_type)
                  for r in t["medicine_package_container"].collect())
    nid, mid, hid = med["Napa"].brand_id, med["Moxa"].brand_id, med["Herbo"].brand_id
    assert cont == sorted([(nid, None, "1.20", "Unit-Priced"),
                           (mid, "100 ml bottle", "80.00", "Bottle"),
                           (mid, "60 ml bottle", "1050.00", "Bottle"),
                           (hid, "10 gm tube", "None", "Tube"), (hid, "15 gm tube", "None", "Tube")])
    packs = [(r.brand_id, r.pack_size, str(r.pack_price)) for r in t["medicine_package_size"].collect()]
    assert packs == [(nid, 100, "120.00")]
    pairs = sorted((r.generic_id, r.indication_id) for r in t["generic_indication"].collect())
    # (Amoxicillin, Cutaneous), (Herbex, Fever), (Paracetamol, Fever); Blankclass has no class
    assert pairs == [(1, 1), (2, 2), (3, 2)]


def test_command_line(spark, capsys):
    out = tempfile.mkdtemp(prefix="tabulary-cli-")
    assert main(["build", _sources(), out]) == 0
    assert "ok  fk medicine.manufacturer_id: 0" in capsys.readouterr().out
    assert main(["validate", out]) == 0
    assert TableStore(spark, f"{out}/tables").read("medicine").count() == 3


def test_command_line_published_expectations_fail_on_other_data(spark):
    out = tempfile.mkdtemp(prefix="tabulary-cli-")
    assert main(["build", _sources(), out, "--expect", "published"]) == 1
