"""Reports, rules and checks on hand-made frames."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.plans import quality as Q
from usagelake.plans import reports as P
from usagelake.plans import rules as R

D = date(2024, 1, 1)
OPEN = date(9999, 12, 31)
ACCOUNTS = "account_uuid string, ship_to string, name string, promotion_uuid string, effective date, termination date, per_patient boolean"
CLASSES = "class_uuid string, class_name string, display_name string, display boolean, multiplier int, calc_type string, list_price int, sku string"
SUBS = "subscription_uuid string, consumer_id string, account_uuid string, sold_to string, promotion_uuid string, sub_start date, sub_end date, version int, exception_flag string"


@pytest.fixture
def accounts(frame):
    return frame(ACCOUNTS, ("A1", "s1", "One/Co", "P", D, OPEN, True), ("A2", "s2", "Two", "P", D, OPEN, True))


@pytest.fixture
def classes(frame):
    return frame(CLASSES, ("c1", "PerPatientFee", "Per patient", True, 1, "PerSubscription", 950, "k"), ("c2", "PerCycleFeeExceptionPreInvoice", "Credit", True, -1, "PerCycle", 200, "k"),
                 ("c3", "FollowUpVisit", "Hidden", False, 1, "PerSubscription", 0, None))


def test_source_files(frame):
    df = frame("file_id string, external_serial string, internal_serial string, device_type string, message_type string, file_stamp string, file_port string, file_cycle_nbr string, log_start timestamp, log_end timestamp, updated_at timestamp",
               ("f1", "e", "i", "COM3", "UL", "20240102030405.csv", "", None, None, None, datetime(2024, 1, 1)), ("f2", "e", "i", "COM3", "UL", "20240102030405.csv", "", None, None, None, datetime(2024, 1, 2)),
               ("f3", "e", "i", "COM1", "UL", "20240102030405", "", None, None, None, datetime(2024, 1, 2)))
    got = P.source_files(df, frame("file_id string, time_zone string", ("f1", "z"), ("f1", "y")))
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert rows_of(got, "file_id", "log_start", "unique_sequence", "time_zone", "external_serial") == [("f1", at, 2, "y", "E"), ("f2", at, 1, None, "E"), ("f3", None, 1, None, "E")]


def test_invoice_summary(frame, accounts, classes):
    inv = frame("invoice_date date, account_uuid string, class_uuid string, promotion_uuid string, sold_to string, cycle_count int, visit_count int, amount int",
                (D, "A1", "c1", "P", "so", 3, 2, 1900), (D, "A1", "c2", "P", "so", 4, 1, 800), (D, "A1", "c3", "P", "so", 1, 1, 0))
    got = P.invoice_summary(inv, accounts, classes, frame("invoice_date date, period_start timestamp, period_end timestamp", (D, datetime(2023, 12, 1), datetime(2023, 12, 31))),
                            frame("promotion_uuid string, promotion_name string, country string, file_template string", ("P", "Prog", "US", "base/<FilePath>")), frame("account_id string, name string", ("so", "Sold")))
    assert rows_of(got, "class_name", "class_order", "cycle_count", "amount", "list_price", "quantity", "sold_to_name", "summary_url") == [
        ("PerCycleFeeExceptionPreInvoice", 4, -4, -800, -200, -4, "Sold", "base/s1/2024-01/s1%20One-Co%2001.01.2024%20Summary.xlsx"),
        ("PerPatientFee", 1, 3, 1900, 950, 2, "Sold", "base/s1/2024-01/s1%20One-Co%2001.01.2024%20Summary.xlsx")]
    metrics = P.metrics_report(inv.withColumns({"sales_order": F.lit(None).cast("int"), "invoice_number": F.lit(1), "case_number": F.lit(2)}),
                               frame("promotion_uuid string, promotion_name string, country string", ("P", "Prog", "US")), classes)
    assert rows_of(metrics, "class_name", "n_accounts", "n_orders", "n_invoices", "total_amount") == [("PerCycleFeeExceptionPreInvoice", 1, 0, 1, 800), ("PerPatientFee", 1, 0, 1, 1900)]


def test_invoice_details(frame, accounts, classes):
    subs = frame(SUBS, ("S0", "1234567890", "A1", "so", "P", date(2023, 1, 1), date(2023, 5, 31), 1, None), ("S1", "1234567890", "A1", "so", "P", D, date(2024, 5, 30), 1, None))
    det = frame("detail_uuid string, subscription_uuid string, consumer_id string, account_uuid string, sold_to string, cycle_date date, cycle_count int, charge int, class_uuid string, version int, comments string, created_at timestamp",
                ("d1", "S1", "1234567890", "A2", "so", D, 2, 950, "c1", 1, "X", datetime(2024, 1, 3)), ("d2", "S1", "1234567890", "A2", "so", D, 2, 950, "c1", 2, "X", datetime(2024, 1, 3)))
    got = P.invoice_details(det, subs, accounts, classes, frame("code string, description string", ("X", "Moved from <DifferentShipToNumber> (<DifferentShipToName>) on <ExceptionDate> at <ListPrice>")),
                            frame("consumer_id string, scanned_id int", ("1234567890", 7)))
    assert rows_of(got, "phone", "scanned_id", "initial_visit", "previous_start", "charge", "data_period", "comment_text") == [
        ("123-456-7890", 7, D, date(2023, 1, 1), 950, "Jan-24", "Moved from s1 (One/Co) on 01-03-2024 at 950")]


def test_eligible_cycles_and_different_sold_to(frame, accounts, classes):
    cycles = frame("cycle_id int, consumer_id string, ship_to string, sold_to string, cycle_date date, card string, device_type string, error_code string, z_code string",
                   (1, "c", "s1", "so", date(2024, 2, 1), "k", "T", None, None), (2, "c", "s2", "so", date(2024, 2, 1), "k", "T", None, None), (3, "c", "s2", "zz", date(2024, 2, 1), "k", "T", None, None),
                   (4, "c", "s1", "so", date(2024, 2, 1), "k", "T", "E1", None), (5, "c", "s1", "so", date(2024, 9, 1), "k", "T", None, None))
    subs = frame(SUBS, ("S1", "c", "A1", "so", "P", D, date(2024, 5, 30), 1, "N"), ("S2", "c", "A1", "so", "P", D, date(2024, 6, 30), 1, "Y"))
    promos = frame("promotion_uuid string, promotion_name string, device_type string, country string, effective date, termination date", ("P", "Prog", "T", "US", D, OPEN))
    got = P.eligible_with_subscription(cycles, accounts, subs, promos, frame("card string, promotion_uuid string, effective date, termination date", ("k", "P", D, OPEN)))
    assert rows_of(got, "cycle_id", "subscription_uuid", "sub_ship_to", "account_uuid") == [(1, "S1", "s1", "A1"), (2, "S1", "s1", "A2")]
    det = frame("consumer_id string, subscription_uuid string, account_uuid string, sold_to string, cycle_date date, cycle_count int, class_uuid string, version int",
                ("c", "S1", "A1", "so", D, 1, "c1", 1), ("c", "S1", "A2", "other", D, 1, "c1", 1), ("d", "S2", "A1", "so", D, 1, "c1", 1))
    got = P.different_sold_to(det, subs, accounts, classes, frame("consumer_id string, scanned_id int", ("c", 1)))
    assert rows_of(got, "ship_to", "sold_to", "sold_to_comment") == [("s1", "so", "SameShipToSameSoldTo"), ("s2", "other", "DifferentShipToDifferentSoldTo")]


def test_cycle_report_and_non_compliance(frame, accounts):
    cycles = frame("file_id string, external_serial string, applicator_cfg string, device_type string, error_code string, z_code string, event_start timestamp, event_end timestamp",
                   ("f", "e", "CFG1234-x", "COM3", None, "123", datetime(2024, 1, 1, 1, 1, 1, 500), datetime(2024, 1, 1, 2)), ("f", "e", "no", "CT", "Z1", None, datetime(2024, 1, 1), None), ("g", "e", "no", "CT", None, None, None, None))
    errors = frame("device_type string, error_code string, event_text string, error_description string", ("COM3", "Z123", "t1", "d1"), ("CT", "Z1", "t2", "d2"))
    got = P.cycle_report(cycles, frame("applicator_cfg string, applicator_name string", ("CFG1234", "Big")), errors, frame("file_id string, external_serial string, time_zone string", ("f", "e", "UTC")))
    assert rows_of(got, "applicator_name", "error_description", "time_zone", "begin_time") == [("Big", "d1", "UTC", datetime(2024, 1, 1, 1, 1, 1)), (None, "d2", "UTC", datetime(2024, 1, 1))]
    findings = frame("active boolean, subscription_uuid string, promotion_uuid string, account_uuid string, cycle_account_uuid string, fraud_class_uuid string, consumer_id string, sold_to string, cycle_count int, cycle_date date",
                     (True, "S1", "P", "A1", "A2", "F", "1234567890", "so", 5, D), (False, "S1", "P", "A1", "A2", "F", "1234567890", "so", 5, D), (True, "S9", "P", "A1", "A2", "F", "1234567890", "so", 5, D))
    subs = frame(SUBS, ("S1", "c", "A1", "so", "P", D, OPEN, 1, None), ("S9", "c", "A1", "so", "P", D, OPEN, 2, None))
    got = P.non_compliance(findings, subs, accounts, frame("fraud_class_uuid string, rule_name string, rule_category string, base_limit int", ("F", "r", "c", 3)),
                           frame("promotion_uuid string, promotion_name string, country string", ("P", "Prog", "US")), frame("consumer_id string, scanned_id int", ("1234567890", 1)), frame("account_id string, name string", ("so", "S")))
    assert rows_of(got, "ship_to", "cycle_ship_to", "phone", "rule_name") == [("s1", "s2", "123-456-7890", "r")]
    rows = frame("country string", ("US",), ("CA",))
    assert rows_of(P.card_mismatch(rows)) == [("US",)] and rows_of(P.card_mismatch(rows, abroad=True)) == [("CA",)]


def test_rule_steps_keep_each_programmes_order(frame):
    rules = [R.Rule("a", "x", "1", 1, "P"), R.Rule("b", "x", "a + 1", 2, "P"), R.Rule("v", "x", "v * 10", 3, "P"),
             R.Rule("b", "x", "5", 1, "Q"), R.Rule("a", "x", "b + v", 2, "Q"), R.Rule("z", "x", "1", 9, "P", active=False), R.Rule("old", "x", "1", 9, "P", termination=date(2020, 1, 1))]
    df = frame("promotion_uuid string, v int", ("P", 3), ("Q", 3), ("dropped", 3))
    got = R.apply_rules(df, rules, "x", promotions=["P", "Q"], as_of=D)
    assert rows_of(got, "promotion_uuid", "a", "b", "v") == [("P", 1, 2, 30), ("Q", 8, 5, 3)] and "z" not in got.columns and "old" not in got.columns
    audit = R.rule_audit(got, "x", "me", datetime(2024, 1, 1))
    assert rows_of(audit, "PROMOTION_UUID", "A", "RULECATEGORY") == [("P", "1", "x"), ("Q", "8", "x")]


def test_rule_table_round_trip_and_change_only_upsert(spark):
    rules = [*R.seed_rules("P"), *R.seed_rules("Q", full=False)]
    table = R.rules_to_frame(spark, rules)
    assert sorted(R.rules_from_frame(table), key=str) == sorted(rules, key=str) and table.count() == 80
    changed = table.where("name = 'charge'").withColumn("code", F.lit("0"))
    after = R.upsert_rules(table, changed)
    assert after.count() == 80 and after.where("code = '0'").count() == 2


def test_checks(frame):
    at = datetime(2024, 1, 31, 12)
    start, end = datetime(2024, 1, 1), datetime(2024, 2, 1)
    visits = frame("account_uuid string, consumer_id string, promotion_uuid string, cycle_date date, cycle_count int, created_at timestamp",
                   ("A", "1", "P", D, 2, at), ("A", "1", "P", D, 1, at), ("A", "2", "P", D, 1, datetime(2024, 1, 31, 23, 50)), ("A", "3", "P", D, 1, at))
    schema = "account_uuid string, consumer_id string, promotion_uuid string, cycle_date date, cycle_count int, charge int, created_at timestamp, updated_at timestamp, created_by string, invoiced boolean, pilot_flag string, class_name string, sub_end date, version int"
    details = frame(schema, ("A", "1", "P", D, 3, 950, at, at, "x", None, None, "PerPatientFee", D, 1), ("A", "4", "P", D, 1, 0, at, at, "patch 7", None, None, "c", D, 1),
                    ("A", "5", "P", D, 1, 0, at, at, "x", None, "Y", "c", D, 1), ("A", "6", "P", D, 1, 0, at, at, "x", True, None, "c", D, 1))
    got = Q.check_cycle_counts(visits, details, start, end)
    assert rows_of(got, "consumer_id", "verdict") == [("1", "Matched"), ("2", "Received at the period end"), ("3", "Unknown"), ("4", "Data patch"), ("5", "Pilot subscription"), ("6", "Already invoiced")]
    assert Q.failures(got).count() == 1 and Q.check_result(got, "counts", at).first()[:4] == ("counts", 6, 1, "Failed")
    expected = visits.groupBy(*Q.BILL_KEYS).agg(F.max("created_at").alias("created_at")).withColumns({"charge": F.lit(Decimal(950)), "class_name": F.lit("PerPatientFee")})
    assert ("1", "Matched") in rows_of(Q.check_charges(expected, details, start, end), "consumer_id", "verdict")
    assert ("1", "Matched") in rows_of(Q.check_class(expected, details, start, end), "consumer_id", "verdict")
    assert ("1", "Matched") in rows_of(Q.check_visit_dates(visits, details, start, end), "consumer_id", "verdict")
    exceptions = frame("case_number string, subscription_uuid string, ship_to string, credit_amount int, exception_created timestamp", ("k1", "S1", "s", 950, at), ("k2", "S1", "s", 950, at), ("k3", "S1", None, 0, at))
    got = Q.check_exceptions(exceptions, frame("case_number string", ("k1",)), frame("subscription_uuid string, sub_end date, pilot_flag string, version int", ("S1", D, None, 1)), end)
    assert rows_of(got, "case_number", "verdict") == [("k1", "Matched"), ("k2", "Unknown"), ("k3", "Invalid account")]


def test_midway_and_set_checks(frame):
    rows = frame("ship_to string, period int, class_order int, amount int", ("a", 1, 15, 10), ("b", 1, 15, 5), ("a", 1, 1, 7))
    assert rows_of(Q.midway_summary(rows, ["period"], "ship_to"), "n_accounts", "description", "total") == [(2, "midway", 15)]
    a, b = frame("k int", (1,), (1,), (2,), (None,)), frame("k int", (2,))
    assert rows_of(Q.missing_rows(a, b, ["k"])) == [(1,), (None,)] and rows_of(Q.stored_rows(a, b, ["k"])) == [(2,)]
