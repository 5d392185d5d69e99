"""Slow single-process renditions that the Spark results are compared with."""

import math

import numpy as np
import pandas as pd


def median(values):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    if not known:
        return None
    middle = len(known) // 2
    return known[middle] if len(known) % 2 else (known[middle - 1] + known[middle]) / 2


def pandas_series(values):
    return pd.Series(values, dtype=float)


def known(series):
    return [None if math.isnan(v) else v for v in series]


def history(rows, brand, date, order, value, null_first=False):
    """Lag and trailing mean of each row index, walking one brand after another."""
    by_brand = {}
    for i, row in enumerate(rows):
        by_brand.setdefault(row[brand], []).append(i)

    def place(i):
        keys = [rows[i][k] for k in order]
        return (rows[i][date] is None, rows[i][date] or 0, *([(k is not None, k or 0) for k in keys] if null_first else keys))

    lag, mean = {}, {}
    for members in by_brand.values():
        members.sort(key=place)
        sales = pandas_series([rows[i][value] for i in members])
        for i, a, b in zip(members, known(sales.shift(1).ffill().bfill()), known(sales.rolling(3, min_periods=1).mean())):
            lag[i], mean[i] = a, b
    return lag, mean


def zscores(values):
    x = np.array([np.nan if v is None else v for v in values], float)
    known = x[~np.isnan(x)]
    if len(known) < 2:
        return np.full(len(x), np.nan)
    return (x - known.mean()) / (known.std(ddof=1) + 1e-6)


def daily_summary(frame: pd.DataFrame, order, filled, scored, plain):
    """Row by row fill, history, z-scores, then totals by (category, brand, date)."""
    f = frame.copy()
    for c in filled:
        m = median(f[c].astype(float).tolist())
        f[c] = [m if v is None or pd.isna(v) else float(v) for v in f[c]]
    codes = {c: {v: i for i, v in enumerate(sorted(f[c].dropna().unique()))} for c in ("category", "brand", "region")}
    rows = f.to_dict("records")
    for r in rows:
        r["sale_date"] = None if pd.isna(r["sale_date"]) else r["sale_date"]
    lag, mean = history(rows, "brand", "sale_date", order, "total_sales")
    f["sales_lag_1"] = [lag[i] for i in range(len(f))]
    f["sales_ma_3"] = [mean[i] for i in range(len(f))]
    for c in scored:
        f[c] = zscores(f[c].tolist())
    groups = {}
    for i, r in enumerate(rows):
        if r["sale_date"] is not None and r["category"] is not None and r["brand"] is not None:
            groups.setdefault((r["category"], r["brand"], r["sale_date"]), []).append(i)
    out = {}
    for key, members in groups.items():
        part = f.iloc[members]
        first = min(members, key=lambda i: tuple(rows[i][k] for k in order))
        got = {"total_sales": part["total_sales"].sum(), "quantity_sold": np.nansum(part["quantity_sold"]),
               "region_encoded": codes["region"][rows[first]["region"]],
               "category_encoded": codes["category"][key[0]], "brand_encoded": codes["brand"][key[1]]}
        for c in [*scored, *plain]:
            if c != "quantity_sold":
                known = part[c].dropna()
                got[c] = known.mean() if len(known) else None
        out[key] = got
    return out
