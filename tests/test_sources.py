import json

import pytest

from checks.fixtures import workbook_bytes
from scrubline import fixed
from scrubline.sources import csv_files, manifests, sinks, workbooks

# --- CSV --------------------------------------------------------------------------


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_parts_layouts_together(spark, tmp_path):
    write(tmp_path, "a.csv", "partNo,partName,cat,measure,partStatus\nPN-4711,Gasket,Seals,EA,retired\n")
    write(tmp_path, "b.csv", "partNo,partName,cat,measure,status\nPN-4712,Sleeve,Seals,EA,active\n")
    write(tmp_path, "c.csv", "partNo,partName,cat,measure\nPN-4713,Dowel,Seals,EA\n")
    write(tmp_path, "d.csv", "partNo,partName,uom,cat,status,legacy_ref\nPN-4714,Plug,EA,Covers,active,x\n")
    write(tmp_path, "e.csv", "part_number,name,uom,category,status,superseded_by,created_at,legacy_ref\n"
                             "007,Shaft,EA,Drives,active,PN-4711,2021-11-30,\n")
    parts = csv_files.read_parts(spark, str(tmp_path))
    assert parts.columns == fixed.PART_COLUMNS
    assert sorted(tuple(r) for r in parts.collect()) == [
        ("007", "Shaft", "Drives", "EA", "active"),
        ("PN-4711", "Gasket", "Seals", "EA", "retired"),
        ("PN-4712", "Sleeve", "Seals", "EA", "active"),
        ("PN-4713", "Dowel", "Seals", "EA", None),
        ("PN-4714", "Plug", "Covers", "EA", "active"),
    ]


def test_layout_can_be_forced(spark, tmp_path):
    path = write(tmp_path, "a.csv", "partNo,partName,cat,measure\nPN-4711,Gasket,Seals,EA\n")
    assert csv_files.read_parts(spark, path, "v1").first().uom == "EA"
    assert csv_files.read_parts(spark, path, "v2").first().uom is None
    assert csv_files.read_parts(spark, path, "other").first().uom == "EA"


def test_csv_dialect_and_null_tokens(spark, tmp_path):
    path = write(
        tmp_path, "s.csv",
        'Supplier Code,NAME,country,email,active\n'
        'S1,"He said ""hi""",NA,a@x.com,1\nS2,"two\nlines",null,,0\n\nS3, padded ,DE,N/A\n',
    )
    rows = sorted(tuple(r) for r in csv_files.read_suppliers(spark, path).collect())
    assert rows == [
        ("S1", 'He said "hi"', None, "a@x.com", "1"),
        ("S2", "two\nlines", None, None, "0"),
        ("S3", " padded ", "DE", None, None),
    ]
    kept = csv_files.read_suppliers(spark, path, tokens=[""])
    assert {r.country for r in kept.collect()} == {"NA", "null", "DE"}


def test_supplier_aliases(spark, tmp_path):
    path = write(tmp_path, "s.csv", "supplier_name,supplier_code,country,email\nQuarry Lane,Q7,NZ,ask@quarry.example\n")
    assert tuple(csv_files.read_suppliers(spark, path).first()) == ("Q7", "Quarry Lane", "NZ", "ask@quarry.example", None)
    both = write(tmp_path, "t.csv", "supplier_name,name\nQuarry Lane,Mill Road\n")
    with pytest.raises(ValueError, match="name"):
        csv_files.read_suppliers(spark, both)


def test_encodings_are_told_apart_per_file(spark, tmp_path):
    name = "Café “X” €5 – Œuvre™ ÿþ"
    text = f"supplier_code,name\n%s,{name}\n"
    write(tmp_path, "a.csv", text % "S1", "cp1252")
    write(tmp_path, "b.csv", text % "S2")
    write(tmp_path, "c.csv", text % "S3", "utf-8-sig")
    write(tmp_path, "d.csv", text % "S4", "utf-16")
    write(tmp_path, "e.csv", "supplier_code,name\nS5,plain\n", "cp1252")
    probed = {r.path.rsplit("/", 1)[1]: r.encoding for r in csv_files.probe_files(spark, str(tmp_path)).collect()}
    assert probed == {"a.csv": "windows-1252", "b.csv": "utf-8", "c.csv": "utf-8", "d.csv": "utf-16", "e.csv": "utf-8"}
    read = {r.supplier_code: r.name for r in csv_files.read_suppliers(spark, str(tmp_path)).collect()}
    assert read == {"S1": name, "S2": name, "S3": name, "S4": name, "S5": "plain"}


def test_clean_csv_reads_back(spark, frame, tmp_path):
    rows = [("PN-4711", ' a "b", c\nd ', None, "EA", "active")]
    schema = ", ".join(f"{c} string" for c in fixed.PART_COLUMNS)
    sinks.write_clean_csv(frame(rows, schema), str(tmp_path / "out"))
    assert [tuple(r) for r in csv_files.read_parts(spark, str(tmp_path / "out")).collect()] == rows


def test_rows_with_too_many_cells_are_not_cut(spark, tmp_path):
    good = 'S2,"fine, quoted"\nS3,short,,\nS4\n'
    path = write(tmp_path, "s.csv", f"code,name\nS1,Hill, Ltd.\n{good}")
    with pytest.raises(Exception, match="S1,Hill, Ltd."):
        csv_files.read_suppliers(spark, path).count()
    kept = csv_files.read_suppliers(spark, path, bad_rows="skip")
    assert kept.count() == 3
    assert {(r.supplier_code, r.name) for r in kept.collect()} == {
        ("S2", "fine, quoted"), ("S3", "short"), ("S4", None),
    }
    rejects = csv_files.csv_rejects(spark, path)
    assert rejects.count() == 1 and rejects.first().record == "S1,Hill, Ltd."
    assert csv_files.csv_rejects(spark, write(tmp_path, "t.csv", f"code,name\n{good}")).count() == 0
    with pytest.raises(ValueError):
        csv_files.read_suppliers(spark, path, bad_rows="cut")


def test_only_files_with_line_breaks_in_cells_are_read_whole(spark, tmp_path):
    write(tmp_path, "a.csv", 'code,name\nS1,"one\nline, more"\n')
    write(tmp_path, "b.csv", 'code,name\nS2,"two ""quoted"""\n')
    probed = {r.path.rsplit("/", 1)[1]: r.multi_line for r in csv_files.probe_files(spark, str(tmp_path)).collect()}
    assert probed == {"a.csv": True, "b.csv": False}
    read = {r.supplier_code: r.name for r in csv_files.read_suppliers(spark, str(tmp_path)).collect()}
    assert read == {"S1": "one\nline, more", "S2": 'two "quoted"'}


def test_a_large_file_is_split_and_keeps_its_order(spark, tmp_path):
    lines = "".join(f"S{i:05d},name {i}\n" for i in range(5000))
    write(tmp_path, "a.csv", "\ncode,name\n" + lines)
    write(tmp_path, "b.csv", "name,code\nlast,T1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    try:
        heads = csv_files.probe_headers(spark, str(tmp_path)).collect()
        assert sorted(r.header for r in heads) == ["code,name", "name,code"]
        read = csv_files.read_suppliers(
            spark, str(tmp_path), encoding="utf-8", multi_line=False, positions=True
        )
        assert read.rdd.getNumPartitions() > 3
        rows = read.orderBy(csv_files.POSITION).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.supplier_code for r in rows] == [*(f"S{i:05d}" for i in range(5000)), "T1"]


def test_size_settings():
    sizes = {"20000b": 20000, "16m": 16 << 20, "128MB": 128 << 20, "1g": 1 << 30, "77": 77}
    assert {s: csv_files._bytes(s) for s in sizes} == sizes


def test_utf16_files_take_one_job_for_their_headers(spark, tmp_path):
    for i in range(4):
        write(tmp_path, f"{i}.csv", f"code,name{',extra' * i}\nS{i},Zürich {i}{',x' * i}\n", "utf-16")
    heads = csv_files._utf16_headers(spark, [str(p) for p in tmp_path.glob("*.csv")])
    assert sorted(len(h) for h in heads.values()) == [2, 3, 4, 5]


# --- workbooks ----------------------------------------------------------------------


def cell(place, value, kind="inlineStr", style=None):
    body = f"<is><t>{value}</t></is>" if kind == "inlineStr" else f"<v>{value}</v>"
    return f'<c r="{place}" t="{kind}"' + (f' s="{style}"' if style else "") + f">{body}</c>"


def test_workbooks(spark, tmp_path):
    banner = f'<row r="1">{cell("A1", "Change orders")}</row>'
    first = banner + (
        f'<row r="2">{cell("A2", " CO Number ")}{cell("B2", 0, "s")}{cell("C2", "Description / Notes")}'
        f'{cell("D2", "Opened")}{cell("E2", "Closed")}{cell("F2", "Extra")}</row>'
        f'<row r="3">{cell("A3", "CO-1")}{cell("B3", 1, "s")}{cell("C3", " two&#10;lines ")}'
        f'{cell("D3", 45306.5, "n", 1)}{cell("E3", "2024-01-14T08:00:00", "d")}{cell("F3", 5, "n")}</row>'
        f'<row r="5">{cell("A5", "CO-2")}{cell("B5", "nan")}{cell("D5", 45306, "n", 1)}'
        f'{cell("E5", "#N/A", "e")}{cell("F5", 1, "b")}</row>'
    )
    shared = "<si><t>State</t></si><si><r><t>In-</t></r><r><t>Work</t></r><rPh><t>x</t></rPh></si>"
    (tmp_path / "a.xlsx").write_bytes(workbook_bytes(first, shared))
    second = banner + (
        f'<row r="2">{cell("A2", "State")}{cell("B2", "CO Number")}</row>'
        f'<row r="3">{cell("A3", "NA")}{cell("B3", "CO-3")}</row>'
    )
    (tmp_path / "b.xlsx").write_bytes(workbook_bytes(second))
    orders = workbooks.read_change_orders(spark, str(tmp_path / "*.xlsx"))
    assert set(orders.columns) == {"co_number", "state", "description", "opened_at", "closed_at", "Extra"}
    rows = {r.co_number: r.asDict() for r in orders.collect()}
    assert orders.count() == 4 and set(rows) == {"CO-1", "CO-2", "CO-3", None}
    assert rows["CO-1"] == {
        "co_number": "CO-1", "state": "In-Work", "description": "two lines", "Extra": "5",
        "opened_at": "2024-01-15 12:00:00", "closed_at": "2024-01-14 08:00:00",
    }
    assert rows["CO-2"]["opened_at"] == "2024-01-15 00:00:00"
    assert (rows["CO-2"]["closed_at"], rows["CO-2"]["state"], rows["CO-2"]["Extra"]) == (None, None, "True")
    assert rows["CO-3"]["state"] is None


# --- manifests ----------------------------------------------------------------------


def documents(frame, *docs):
    return manifests.manifest_documents(frame([(json.dumps(d),) for d in docs], "value string"))


NESTED = {
    "parts": {"part_number_format_drift": 3, "description": "text"},
    "suppliers": {"near_duplicate_names": 2, "invalid_emails": 1},
    "change_orders": {"state_vocabulary_inconsistency": 4, "impossible_dates": 5},
    "exports": {"merged": True},
}


def counts(manifest):
    return {r.category: r.expected for r in manifests.expected_counts(manifest).collect()}


def test_expected_counts(frame):
    nested = {
        "part_number_non_standard": 3, "supplier_near_duplicates": 2, "invalid_emails": 1,
        "state_vocabulary_variants": 4, "impossible_dates": 5,
    }
    assert counts(documents(frame, {"defects": NESTED})) == nested
    flat = {"defects": {**NESTED, "invalid_emails": 9, "own": 2.7, "flag": True, "note": "x", "no": None}}
    assert counts(documents(frame, flat)) == {**nested, "own": 2, "flag": 1}
    assert counts(documents(frame, {"defects": {"invalid_emails": 9}})) == {"invalid_emails": 9}
    assert counts(documents(frame, {})) == {}


def manifest(**changes):
    return {
        "manifest_version": 2,
        "defects": {"suppliers": {"invalid_emails": 2}},
        "defect_records": {"bad_email_count": ["S1", 7]},
        **changes,
    }


def test_truth_keys_and_parts_of_a_manifest(frame):
    one = documents(frame, manifest())
    manifests.check_manifest(one, [fixed.INVALID_EMAILS, "unheard_of"])
    keys = lambda m: sorted(tuple(r) for r in manifests.truth_keys(m).collect())
    assert keys(one) == [(fixed.INVALID_EMAILS, "7"), (fixed.INVALID_EMAILS, "S1")]
    more = manifest(defects={"suppliers": {"invalid_emails": 1}}, defect_records={"bad_email_count": ["S3"]})
    two = documents(frame, manifest(), more)
    manifests.check_manifest(two, [fixed.INVALID_EMAILS])
    assert len(keys(two)) == 3 and counts(two) == {fixed.INVALID_EMAILS: 3}


@pytest.mark.parametrize(
    "changes, error, text",
    [
        ({"manifest_version": 1}, ValueError, "Manifest v2"),
        ({"manifest_version": None}, ValueError, "Manifest v2"),
        ({"defects": {}}, ValueError, "summary count for invalid_emails"),
        ({"defect_records": {}}, ValueError, "defect_records.bad_email_count"),
        ({"defect_records": {"bad_email_count": 2}}, TypeError, "must be a list"),
        ({"defect_records": {"bad_email_count": ["S1"]}}, ValueError, "disagree"),
    ],
)
def test_integrity_errors(frame, changes, error, text):
    with pytest.raises(error, match=text):
        manifests.check_manifest(documents(frame, manifest(**changes)), [fixed.INVALID_EMAILS])


def test_empty_lists_agree_with_zero(frame):
    none = manifest(defects={"suppliers": {"invalid_emails": 0}}, defect_records={"bad_email_count": []})
    manifests.check_manifest(documents(frame, none), [fixed.INVALID_EMAILS])


def test_manifest_file(spark, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps(manifest(), indent=2))
    assert counts(manifests.read_manifest(spark, str(path))) == {fixed.INVALID_EMAILS: 2}


def test_known_header_and_encoding_need_no_probe(spark, tmp_path):
    path = write(tmp_path, "a.csv", "code,name\nS1,Café\n", "cp1252")
    known = csv_files.read_suppliers(spark, path, encoding="windows-1252", header=["code", "name"])
    assert (known.first().supplier_code, known.first().name) == ("S1", "Café")
    forced = csv_files.read_suppliers(spark, path, encoding="cp1252")
    assert forced.first().name == "Café"
    (tmp_path / "empty.csv").write_text("")
    assert csv_files.read_suppliers(spark, str(tmp_path)).count() == 1


def test_small_files_in_the_task_of_a_large_block_are_read(spark, tmp_path):
    header = "supplier_code,supplier_name\n"
    (tmp_path / "big.csv").write_text(header + "".join(f"S{i:06d},name {i}\n" for i in range(48_000)))
    (tmp_path / "small.csv").write_text(header + "T1,small\n")
    size = (tmp_path / "big.csv").stat().st_size
    settings = {
        "spark.sql.files.maxPartitionBytes": str(int(size * 1.05)),
        "spark.sql.files.openCostInBytes": "1000",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = csv_files.read_suppliers(spark, str(tmp_path), encoding="utf-8", multi_line=False)
        assert found.where("supplier_code = 'T1'").count() == 1
        assert found.count() == 48_001
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
