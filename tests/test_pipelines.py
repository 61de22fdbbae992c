import json

import pytest

from scrubline import fixed
from scrubline.plans import pipelines, reports
from scrubline.sources import manifests, sinks
from scrubline.operators import detect as d

DOCUMENT = {
    "manifest_version": 2,
    "defects": {
        "parts": {"part_number_format_drift": 2},
        "suppliers": {"near_duplicate_names": 1, "invalid_emails": 1},
        "change_orders": {"state_vocabulary_inconsistency": 2, "impossible_dates": 1},
    },
    "defect_records": {
        "part_fmt_drift_count": ["P7", "2019-PN-3"],
        "supplier_dupe_count": ["SUP-0003->SUP-0001"],
        "bad_email_count": ["SUP-0002"],
        "co_state_mess_count": ["CO-1", "CO-9"],
        "co_date_flip_count": ["CO-2"],
    },
}


@pytest.fixture
def sources(frame):
    return {
        "parts": frame([("PN-0001",), ("P7",), ("2019-PN-3",), ("BOGUS",), (None,)], "part_number string"),
        "suppliers": frame(
            [("SUP-0001", "Quarry Stone", "a@b.com"), ("SUP-0002", "Mill Components", "bad"),
             ("SUP-0003", "QUARRY STONE", None)],
            "supplier_code string, name string, contact_email string",
        ),
        "change_orders": frame(
            [("CO-1", "OPEN", "2024-01-01", None), ("CO-2", "open", "2024-02-01", "2024-01-01"),
             ("CO-9", "Open", "2024-01-01", "2024-01-02")],
            "co_number string, state string, opened_at string, closed_at string",
        ),
    }


@pytest.fixture
def manifest(frame):
    return manifests.manifest_documents(frame([(json.dumps(DOCUMENT),)], "value string"))


def test_full_report(spark, sources, manifest, tmp_path):
    result = pipelines.report(**sources, manifest=manifest)
    scores = {r.category: (r.expected, r.detected, r.matched) for r in result.scorecard.collect()}
    assert scores == {
        fixed.PART_NUMBERS: (2, 3, 2),
        fixed.NEAR_DUPLICATES: (1, 1, 1),
        fixed.INVALID_EMAILS: (1, 1, 1),
        fixed.STATE_VARIANTS: (2, 1, 1),
        fixed.IMPOSSIBLE_DATES: (1, 1, 1),
        "_overall": (7, 7, 6),
    }
    checks = {r.check: (r.defect_count, r.details) for r in result.checks.collect()}
    assert checks["part_number_eras"] == (4, "record_keys: [2019-PN-3, BOGUS, P7]")
    assert checks["near_duplicate_groups"] == (1, "")
    assert checks["impossible_dates"] == (1, "record_keys: [CO-2]")
    summary = {r.metric: r.value for r in result.summary.collect()}
    assert {r.record_key for r in result.validation.false_positives.collect()} == {"BOGUS"}
    assert {r.record_key for r in result.validation.false_negatives.collect()} == {"CO-9"}
    assert result.validation.pair_false_positives().count() == 0
    details = {(r.check, r.field, r.item, r.parent, r.amount) for r in result.details.collect()}
    assert {
        ("part_number_eras", "eras", "legacy", None, 1.0),
        ("part_number_eras", "unknown", "BOGUS", None, 1.0),
        ("part_number_eras", "unknown", None, None, 1.0),
        ("invalid_emails", "examples", "bad", None, None),
        ("state_variants", "counts", "OPEN", None, 1.0),
        ("state_variants", "unknown", "Open", None, None),
        ("impossible_dates", "unparsed", "closed_at", None, 0.0),
        ("near_duplicate_groups", "groups", "Quarry Stone", None, 1.0),
        ("near_duplicate_groups", "variants", "QUARRY STONE", "Quarry Stone", 100.0),
        ("impossible_dates", "record_keys", "CO-2", None, None),
    } <= details
    assert summary["detected"] == "7" and summary["recall"] == "85.7%"

    rows = reports.report_rows(result.checks, result.scorecard)
    sinks.write_report(reports.envelope(rows, manifest="m.json"), str(tmp_path / "out"))
    written = spark.read.json(str(tmp_path / "out")).collect()
    assert {r.section for r in written} == {"detection", "validation"}
    assert len(written) == 5 + 6 and {r.manifest for r in written} == {"m.json"}
    body = next(json.loads(r.body) for r in written if r.name == "_overall")
    assert body["matched"] == 6


def test_report_without_manifest(sources):
    result = pipelines.report(parts=sources["parts"])
    assert result.scorecard is None and result.groups is None
    assert [tuple(r) for r in result.summary.collect()] == [("defect_count", "4")]
    assert {r.section for r in reports.report_rows(result.checks).collect()} == {"detection"}


def test_validate_scores_only_what_ran(sources, manifest):
    detection = pipelines.detect(change_orders=sources["change_orders"])
    scores = {r.category for r in pipelines.validate(manifest, detection).collect()}
    assert scores == {fixed.STATE_VARIANTS, fixed.IMPOSSIBLE_DATES, "_overall"}


def test_all_defects_lists_pairs(sources):
    detection = pipelines.detect(suppliers=sources["suppliers"])
    rows = {(r.category, r.record_key, r.value) for r in detection.all_defects().collect()}
    assert rows == {
        (fixed.INVALID_EMAILS, "SUP-0002", "bad"),
        (fixed.NEAR_DUPLICATES, "SUP-0003->SUP-0001", "100.0"),
    }


def test_normalize(sources):
    parts, mapping = pipelines.normalize("parts", sources["parts"])
    assert mapping is None and {r[0] for r in parts.collect()} == {
        "PN-0001", "PN-0007", "PN-0003", "BOGUS", None,
    }
    suppliers, mapping = pipelines.normalize("suppliers", sources["suppliers"])
    assert [tuple(r) for r in mapping.collect()] == [("QUARRY STONE", "Quarry Stone")]
    assert {r.name for r in suppliers.collect()} == {"Quarry Stone", "Mill Components"}
    orders, _ = pipelines.normalize("change_orders", sources["change_orders"])
    assert {r.state for r in orders.collect()} == {"open", "Open"}
    with pytest.raises(ValueError):
        pipelines.normalize("invoices", parts)


def test_some_source_is_needed():
    with pytest.raises(ValueError, match="at least one"):
        pipelines.detect()
    with pytest.raises(ValueError, match="at least one"):
        pipelines.report()


def test_a_check_can_be_added(frame, sources, monkeypatch):
    monkeypatch.setattr(pipelines, "CHECKS", list(pipelines.CHECKS))
    short = lambda df, _: d.defects("short_number", df, "part_number", d.F.col("part_number"), d.F.lit("short"))
    pipelines.register(pipelines.Check("parts", ["short_number"], lambda df, o: short(df.where("length(part_number) < 3"), o)))
    pipelines.register(pipelines.Check("invoices", ["any_invoice"], lambda df, _: d.no_defects(df.sparkSession)))
    found = pipelines.detect(parts=sources["parts"], invoices=sources["parts"])
    assert found.categories == [fixed.PART_NUMBERS, "short_number", "any_invoice"]
    assert [r.record_key for r in found.defects.where("category = 'short_number'").collect()] == ["P7"]
    with pytest.raises(ValueError):
        pipelines.register(pipelines.Check("parts", ["none"]))
    with pytest.raises(ValueError, match="memos"):
        pipelines.detect(memos=sources["parts"])


def test_normalize_in_another_order(sources):
    suppliers = sources["suppliers"].selectExpr("*", "-cast(right(supplier_code, 1) as int) as spot")
    _, mapping = pipelines.normalize("suppliers", suppliers, order_col="spot")
    assert [tuple(r) for r in mapping.collect()] == [("Quarry Stone", "QUARRY STONE")]


def test_previews_are_cut(frame):
    keys = [("invalid_emails", f"{'x' * 50}{i}") for i in range(6)]
    line = reports.previews(frame(keys, "category string, record_key string")).first().details
    assert len(line) == 120 and line.startswith("record_keys: [xxx")


def test_streams(spark, sources, tmp_path):
    path = str(tmp_path / "orders")
    sources["change_orders"].write.parquet(path)
    stream = spark.readStream.schema(sources["change_orders"].schema).parquet(path)
    query = (
        d.change_order_defects(stream)
        .writeStream.format("memory")
        .queryName("live_defects")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert {(r.category, r.record_key) for r in spark.table("live_defects").collect()} == {
        (fixed.STATE_VARIANTS, "CO-1"),
        (fixed.IMPOSSIBLE_DATES, "CO-2"),
    }
