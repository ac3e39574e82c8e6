"""A direct, row-at-a-time Python model of the four stages, for small inputs.

Brute force over every schedule day: ``round(i / d, 2)`` in Python, a
first-match lookup of the curve, first date per value, running sums in plain
Decimal arithmetic, with the orderings this package fixes for "first". Used
only by the tests as an oracle on random inputs.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import numpy as np

K = ("PROJECT_NUMBER", "STAGE", "SUB_STAGE")


def _key(r):
    return tuple(r[c] for c in K)


def _nulls_last(*vals):
    out = []
    for v in vals:
        out += [v is None, v if v is not None else 0]
    return tuple(out)


def budget_by_key(budget_rows):
    acc = {}
    for r in budget_rows:
        k = _key(r)
        v = r["BUDGET_CURRENT_APPROVED"]
        if k not in acc:
            acc[k] = v
        elif v is not None:
            acc[k] = v if acc[k] is None else acc[k] + v
    return acc


def actual_value(sources, budget_rows, schedule_rows):
    bk = budget_by_key(budget_rows)
    sched = defaultdict(list)
    for s in schedule_rows:
        sched[_key(s)].append(s)
    groups = defaultdict(list)
    for r in sources:
        k = _key(r)
        if any(v is None for v in k) or r["INVOICE_DATE"] is None:
            continue
        for s in sched.get(k, [None]):
            groups[(k, r["INVOICE_DATE"])].append((r, s))
    out = []
    for (k, d), rows in groups.items():
        total = sum((r["ACTUALS_COST"] or Decimal(0) for r, _ in rows), Decimal(0))
        if total == 0:
            continue
        ordered = sorted(rows, key=lambda rs: _nulls_last(
            rs[1]["CURRENTSTART"] if rs[1] else None, rs[1]["CURRENTEND"] if rs[1] else None))
        starts = [s["CURRENTSTART"] for _, s in ordered if s and s["CURRENTSTART"] is not None]
        ends = [s["CURRENTEND"] for _, s in ordered if s and s["CURRENTEND"] is not None]
        out.append(dict(zip(K, k), INVOICE_DATE=d, ACTUALS_COST=total,
                        BUDGET_CURRENT_APPROVED=bk.get(k),
                        CURRENTSTART=starts[0] if starts else None,
                        CURRENTEND=ends[0] if ends else None))
    out.sort(key=lambda r: (_key(r), r["INVOICE_DATE"]))
    run, last = Decimal(0), None
    for r in out:
        if _key(r) != last:
            run, last = Decimal(0), _key(r)
        run += r["ACTUALS_COST"]
        r["CUMULATIVE_ACTUAL_COST"] = run
    return out


def _code(label):
    if label is None:
        return None
    n = 0
    while n < len(label) and (label[n].isdigit() or ("A" <= label[n] <= "Z")):
        n += 1
    return label[:n] or None


def planned_value(budget_rows, schedule_rows, curve_rows):
    bk = budget_by_key(budget_rows)
    # first curve point per (code, rounded percent), in (percent, value) order
    lookup = {}
    for c in sorted(curve_rows, key=lambda c: _nulls_last(c["PERCENT_COMPLETIONTIME"],
                                                          c["NORM_PERCENT_CUMSPENT"])):
        p = c["PERCENT_COMPLETIONTIME"]
        if p is not None:
            lookup.setdefault((_code(c["SUBSTAGES"]), float(np.round(p, 2))), c["NORM_PERCENT_CUMSPENT"])
    firsts = {}
    for s in sorted(schedule_rows, key=lambda s: _nulls_last(s["CURRENTSTART"], s["CURRENTEND"])):
        k = _key(s)
        if k in bk and None not in k:
            firsts.setdefault(k, s)
    earliest = {}
    for k, s in firsts.items():
        start, end = s["CURRENTSTART"], s["CURRENTEND"]
        if start is None or end is None or not start < end:
            continue
        d = (end - start).days + 1
        budget = Decimal(0) if bk[k] is None else bk[k]
        percents = [round(i / d, 2) for i in range(d)]
        values = [lookup.get((k[2], pct), Decimal(0)) for pct in percents]
        for i, v in enumerate(values):
            if v is not None and (k, v) not in earliest:
                earliest[(k, v)] = (start + dt.timedelta(days=i), v * budget)
    out = [dict(zip(K, k), NORMALIZED_PERCENT=v, DATE=when, PLANNED_CURVE_VALUE=amount)
           for (k, v), (when, amount) in earliest.items()]
    out.sort(key=lambda r: (_key(r), r["DATE"]))
    run, last = Decimal(0), None
    for r in out:
        if _key(r) != last:
            run, last = Decimal(0), _key(r)
        run += r["PLANNED_CURVE_VALUE"]
        r["CUMULATIVE_PLANNED_CURVE"] = run
    return out


def forecast_value(planned, actual, as_of: dt.date):
    cutoff = dt.datetime(as_of.year, as_of.month, as_of.day)
    pos = {}
    for r in actual:
        k = _key(r)
        p = pos.setdefault(k, {"total": Decimal(0), "budget": None, "last": None, "cum": None})
        p["total"] += r["ACTUALS_COST"]
        if r["BUDGET_CURRENT_APPROVED"] is not None:
            p["budget"] = max(p["budget"], r["BUDGET_CURRENT_APPROVED"]) if p["budget"] is not None \
                else r["BUDGET_CURRENT_APPROVED"]
        if p["last"] is None or r["INVOICE_DATE"] > p["last"]:
            p["last"], p["cum"] = r["INVOICE_DATE"], r["CUMULATIVE_ACTUAL_COST"]
    fut = defaultdict(list)
    for r in planned:
        if _key(r) in pos and r["DATE"] > cutoff:
            fut[_key(r)].append(r)
    out = []
    for k, rows in fut.items():
        p = pos[k]
        rows.sort(key=lambda r: r["DATE"])
        total = sum((r["PLANNED_CURVE_VALUE"] for r in rows), Decimal(0))
        rem = None if p["budget"] is None else max(Decimal(0), p["budget"] - p["total"])
        run = Decimal(0)
        for r in rows:
            run += r["PLANNED_CURVE_VALUE"]
            share = 0.0 if total == 0 else float(r["PLANNED_CURVE_VALUE"]) / float(total)
            cshare = 0.0 if total == 0 else float(run) / float(total)
            fv = None if rem is None else share * float(rem)
            final = None if rem is None else cshare * float(rem) + float(p["cum"])
            out.append(dict(zip(K, k), FORECAST_DATE=r["DATE"], FORECAST_VALUE=fv,
                            FORECAST_FINAL_VALUE=final))
    return out
