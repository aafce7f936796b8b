"""Reports against plain Python on a small warehouse with history and a hot policy."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import rows

from premia.plans import reports

OPEN = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2012, 1, 1) + dt.timedelta(n)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    customers = []
    for c in range(12):
        for v in range(1 + c % 2):
            flag = 1 if v == c % 2 else 0
            customers.append((f"c{c}v{v}", str(c), f"N{c}", "S", ["M", "D"][v if c % 4 == 1 else 0], "F", day(v), OPEN, flag, ["East", "West", "South"][c % 3]))
    policies = []
    for p in range(40):
        pid = "hot" if p % 3 == 0 else f"p{p % 5}"
        kind = ["Auto", "Home", "Life", None][rng.randrange(4)]
        policies.append((f"k{p}", pid, f"Plan {kind}", kind and kind[0], kind, ["Quarterly", "Yearly"][p % 2], day(rng.randrange(500)), OPEN, Decimal(rng.randrange(1, 999))))
    addresses = [(f"a{i}", "USA", "ST", f"City{i % 3}", str(i)) for i in range(6)]
    facts = []
    for _ in range(300):
        sk = None if rng.random() < 0.1 else rng.choice(addresses)[0]
        d = day(rng.randrange(700))
        facts.append((rng.choice(customers)[0], rng.choice(policies)[0], sk, int(f"{d:%Y%m%d}")))
    return customers, policies, addresses, facts


@pytest.fixture(scope="module")
def tables(spark, data):
    customers, policies, addresses, facts = data
    return {
        "dim_customer": spark.createDataFrame(
            customers,
            "customer_sk string, customer_id string, customer_name string, customer_segment string, marital_status string, "
            "gender string, eff_start_dt date, eff_end_dt date, current_flag int, region string",
        ),
        "dim_policy": spark.createDataFrame(
            policies,
            "policy_sk string, policy_id string, policy_name string, policy_type_id string, policy_type string, "
            "policy_term string, policy_start_dt date, policy_end_dt date, total_policy_amt decimal(18,2)",
        ),
        "dim_policy_type": spark.createDataFrame([("A", "Auto", "cars"), ("H", "Home", "houses")], "policy_type_id string, policy_type_name string, policy_type_desc string"),
        "dim_address": spark.createDataFrame(addresses, "address_sk string, country string, state_province string, city string, postal_code string"),
        "fact_policy_txn": spark.createDataFrame(facts, "customer_sk string, policy_sk string, address_sk string, date_sk int"),
    }


def facts_with_dims(data):
    customers, policies, _, facts = data
    by_c, by_p = {c[0]: c for c in customers}, {p[0]: p for p in policies}
    return [(by_c[f[0]], by_p[f[1]], f) for f in facts]


def ordered(values):
    return sorted(values, key=lambda r: [(c is not None, str(c)) for c in r])


def test_policy_type_changes(tables, data):
    short, full = set(), set()
    for c, cur, _ in facts_with_dims(data):
        for prev in data[1]:
            if prev[1] == cur[1] and cur[6] > prev[6] and cur[4] and prev[4] and cur[4] != prev[4]:
                full.add((c[1], c[2], cur[4], cur[1], cur[2], prev[4], prev[1], prev[2]))
                if c[8] == 1:
                    short.add((c[1], c[2], cur[4], prev[4], cur[1]))
    assert short and rows(reports.changed_policy_type(tables)) == ordered(short)
    assert full and rows(reports.changed_policy_details(tables)) == ordered(full)


def test_amounts(tables, data):
    total, auto, term = defaultdict(Decimal), defaultdict(Decimal), defaultdict(Decimal)
    for c, p, _ in facts_with_dims(data):
        who = (c[1], c[2], c[9])
        total[who] += p[8]
        if p[4] == "Auto":
            auto[(*who, "Auto")] += p[8]
        if c[9] in ("East", "West") and p[5] == "Quarterly" and p[6].year == 2012 and c[8] == 1:
            term[(*who, p[5], p[6])] += p[8]
    for got, want in (
        (reports.amounts_by_customer(tables), total),
        (reports.amounts_by_type(tables), auto),
        (reports.amounts_by_term(tables), term),
    ):
        assert want
        assert rows(got) == ordered([(*k, v) for k, v in want.items()])


def test_marital_history(tables, data):
    statuses = defaultdict(set)
    for c in data[0]:
        statuses[c[1]].add(c[4])
    want = [(c[1], c[2], c[2], c[2], c[3], c[4], c[6], c[7]) for c in data[0] if len(statuses[c[1]]) > 1]
    got = [tuple(r) for r in reports.marital_history(tables).collect()]
    assert want and got == sorted(want, key=lambda r: (r[0], r[6]))


def test_listing_has_a_line_per_transaction(tables, data):
    address = {a[0]: a for a in data[2]}
    desc = {"A": "cars", "H": "houses"}
    want = []
    for c, p, f in facts_with_dims(data):
        if c[8] == 1:
            a = address.get(f[2], (None,) * 5)
            want.append((c[9], c[1], c[2], c[3], c[4], c[5], a[3], a[2], a[4], p[1], p[2], p[4], desc.get(p[3]), p[5], p[6], p[7], p[8]))
    assert rows(reports.full_listing(tables)) == ordered(want)


def test_address_history(tables, data):
    address = {a[0]: a for a in data[2]}
    seen = defaultdict(list)
    for c, _, f in facts_with_dims(data):
        if f[2] and 20120201 <= f[3] <= 20130331:
            seen[(c[1], c[2], f[2])].append(f[3])
    want = [
        (*k, *[address[k[2]][i] for i in (3, 2, 4, 1)], *[dt.datetime.strptime(str(e), "%Y%m%d").date() for e in (min(v), max(v))])
        for k, v in seen.items()
    ]
    got = reports.address_history(tables, dt.date(2012, 2, 1), dt.date(2013, 3, 31))
    assert rows(got) == ordered(want)
    in_order = [(r.customer_id, r.first_seen_date) for r in got.collect()]
    assert in_order == sorted(in_order)


def test_type_changes_by_customer(spark):
    data = [("a", day(1), "X"), ("a", day(1), "W"), ("a", day(5), "Y"), ("a", day(9), "Y"), ("a", None, "Z"), ("b", day(1), "X")]
    df = spark.createDataFrame(data, "customer_id string, policy_start_dt date, policy_type string")
    assert rows(reports.customer_type_changes(df)) == [("a", day(5), "Y", "W")]


def test_reports_may_ignore_case(spark, tables):
    shouted = {**tables, "dim_customer": tables["dim_customer"].selectExpr("* except (customer_name)", "if(current_flag = 1, upper(customer_name), lower(customer_name)) as customer_name")}
    assert reports.amounts_by_customer(shouted).count() > reports.amounts_by_customer(tables).count()
    blind = reports.amounts_by_customer(reports.with_collation(shouted))
    got = {r.customer_id: r.total_policy_amt for r in blind.collect()}
    assert got == {r.customer_id: r.total_policy_amt for r in reports.amounts_by_customer(tables).collect()}
    auto = reports.amounts_by_type(reports.with_collation(tables), "AUTO")
    assert auto.count() == reports.amounts_by_type(tables, "Auto").count() > 0
    for report in reports.REPORTS.values():
        report(reports.with_collation(tables)).collect()
