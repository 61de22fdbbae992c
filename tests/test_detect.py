from scrubline.operators import detect as d
from scrubline.operators import normalize as n


def keys(df):
    return sorted((r.record_key for r in df.collect()), key=lambda k: (k is None, k))


def test_part_numbers(frame):
    parts = frame(
        [(v,) for v in ["PN-3003", "PN-3004", "2019-PN-21", "P31", "P32", "P33", "??", None]],
        "part_number string",
    )
    counts = [(r.era, r.n) for r in d.era_distribution(parts).collect()]
    assert counts == [("legacy", 3), ("current", 2), ("unknown", 2), ("2019", 1)]
    assert keys(d.non_standard_part_numbers(parts)) == ["2019-PN-21", "??", "P31", "P32", "P33", None]
    summary = d.part_number_summary(parts).first()
    assert (summary.non_standard_count, summary.unknown_format_count) == (6, 2)
    assert {r.part_number for r in d.unknown_part_numbers(parts).collect()} == {"??", None}


def test_invalid_emails_count_rows_without_a_code(frame):
    rows = [("S1", "ok@x.com"), ("S2", "bad"), (None, "also bad@x"), ("S4", None), ("S5", "x.invalid")]
    suppliers = frame(rows, "supplier_code string, contact_email string")
    found = d.invalid_emails(suppliers)
    assert keys(found) == ["S2", "S5", None]
    total = d.defect_summary(found).first()
    assert (total.defect_count, total.keyed_count) == (3, 2)
    assert [r.contact_email for r in d.invalid_email_examples(suppliers, n=2).collect()] == [
        "also bad@x", "bad",
    ]


def test_states(frame):
    rows = [("C1", "open"), ("C2", "OPEN"), ("C3", "In-Work"), ("C4", "approved"), ("C5", "CLOSED"),
            ("C6", "Open"), ("C7", None), ("C8", " open"), (None, "REJECTED")]
    orders = frame(rows, "co_number string, state string")
    assert keys(d.state_variants(orders)) == ["C2", "C3", "C5", None]
    assert {(r.state, r.n) for r in d.state_variant_counts(orders).collect()} == {
        ("OPEN", 1), ("In-Work", 1), ("CLOSED", 1), ("REJECTED", 1),
    }
    assert {r.state for r in d.unknown_states(orders).collect()} == {"Open", " open"}
    states = {r.co_number: r.state for r in n.normalize_states(orders).collect()}
    assert states == {"C1": "open", "C2": "open", "C3": "in-review", "C4": "approved",
                      "C5": "closed", "C6": "Open", "C7": None, "C8": " open", None: "rejected"}
    assert n.normalize_states(orders).columns == orders.columns


def test_states_join_is_broadcast(frame):
    orders = frame([("C1", "open")], "co_number string, state string")
    plan = d.state_variants(orders)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_canonical_states_are_no_defects(frame):
    orders = frame([(s,) for s in ["open", "in-review", "approved", "closed", "rejected"]], "state string")
    assert d.state_variants(orders).count() == 0


def test_impossible_dates(frame):
    rows = [("C1", "2022-05-05", "2022-07-01"), ("C2", "2023-01-01", "2022-12-31"),
            ("C3", "2024-06-01", "2024-06-01"), ("C4", "soon", "2024-01-01"),
            ("C5", "2024-01-01", None), ("C6", "2024-01-02 00:00:01", "2024-01-02")]
    orders = frame(rows, "co_number string, opened_at string, closed_at string")
    assert keys(d.impossible_dates(orders)) == ["C2", "C6"]
    assert {(r.column, r.n) for r in d.unparsed_dates(orders).collect()} == {("opened_at", 1), ("closed_at", 0)}
    day_first = frame([("C1", "02.01.2024", "01.01.2024")], "co_number string, opened_at string, closed_at string")
    assert keys(d.impossible_dates(day_first)) == []
    assert keys(d.impossible_dates(day_first, formats=["dd.MM.yyyy"])) == ["C1"]


def test_missing_columns_mean_no_defects(frame):
    other = frame([(1,)], "other int")
    for found in (d.invalid_emails(other), d.state_variants(other), d.impossible_dates(other)):
        assert found.count() == 0
        assert found.columns == ["category", "record_key", "value", "detail"]
    assert d.unknown_states(other).count() == 0
    assert d.invalid_email_examples(other).count() == 0
    assert n.normalize_states(other).collect() == other.collect()


def test_normalizing_leaves_the_input_alone(frame):
    parts = frame([("P7", "bolt")], "part_number string, name string")
    assert n.normalize_parts(parts).collect() == [("PN-0007", "bolt")]
    assert parts.collect() == [("P7", "bolt")]


def test_detection_does_not_depend_on_partitioning(frame):
    rows = [(f"C{i}", "OPEN" if i % 3 else "open") for i in range(50)]
    orders = frame(rows, "co_number string, state string")
    assert keys(d.state_variants(orders.repartition(7))) == keys(d.state_variants(orders.coalesce(1)))
