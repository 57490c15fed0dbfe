"""What people read: a day's report as text and as a page, charts, a bond's history.

Frames are filtered to one day or one bond before they come to the driver, so a surface holds
a book's rows, never a table's.
"""

from __future__ import annotations

import datetime as dt
import html
import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Day:
    """The frames of one day as they are shown."""

    day: dt.date
    tiles: dict
    core: pd.DataFrame
    others: pd.DataFrame
    waiting: pd.DataFrame
    switches: pd.DataFrame
    shape: pd.DataFrame
    curve: pd.DataFrame
    carried: pd.DataFrame
    carry: pd.DataFrame
    forecast: pd.DataFrame
    gap_bp: float | None
    funding: dict


def gather(frames: dict[str, DataFrame], day: dt.date | None = None) -> Day | None:
    """The frames of ``day``, the newest by default; None if there is none.

    ``frames``: tiles, core, others, waiting, switches, shape, curve, carried, carry, forecast,
    gap and funding, each with ``obs_date`` (gap and funding: ``asof``).
    """
    if day is None:
        day = frames["tiles"].agg(F.max("obs_date")).first()[0]
    if day is None:
        return None
    on = lambda name, column="obs_date": frames[name].where(F.col(column) == F.lit(day)).toPandas()
    tiles = on("tiles")
    if tiles.empty:
        return None
    gap, funding = on("gap", "asof"), on("funding", "asof")
    first = lambda df: df.iloc[0].to_dict() if len(df) else {}
    return Day(day, first(tiles), on("core").sort_values("place"), on("others").sort_values(["side", "place"]), on("waiting").sort_values("place"), on("switches").sort_values("place"), on("shape").sort_values("pair"), on("curve"), on("carried"), on("carry"), on("forecast"), first(gap).get("gap_bp"), first(funding))


def _known(value: object) -> bool:
    return value is not None and not (isinstance(value, float) and math.isnan(value)) and value is not pd.NaT


def shown(value: object, digits: int = 1, sign: bool = False, unit: str = "") -> str:
    """A number as it is printed; a dash for none."""
    return f"{value:{'+' if sign else ''}.{digits}f}{unit}" if _known(value) else "-"


def describe_gap(gap_bp: float | None, days: int = 20) -> str:
    if not _known(gap_bp):
        return f"quote-to-trade gap: too few trades in the last {days} days to measure"
    return f"trades printing {abs(gap_bp):.0f}bp {'cheaper' if gap_bp > 0 else 'richer'} than the quote mid over the last {days} days"


def describe_forecast(forecast: pd.DataFrame) -> str:
    if forecast.empty:
        return "dealing: no forecast, too few trades"
    f = forecast.iloc[0]
    text = f"dealing: expect trades {abs(f.market_gap_bp):.0f}bp {'above' if f.market_gap_bp > 0 else 'below'} the quote mid (last {int(f.market_window)} trading days, to {f.trades_through})"
    if _known(f.band50_bp):
        text += f"; half of them within {f.band50_bp:.0f}bp, four in five within {f.band80_bp:.0f}bp"
    return text if f.fresh else f"{text}; the day's trade file is not in yet"


def describe_liquidity(row: pd.Series) -> str:
    parts = [f"Rs {row.turnover_lkr / 1e9:.1f}bn over {int(row.days_traded)}d"]
    if row.get("is_benchmark"):
        parts.append("auctioned of late")
    return "; ".join(parts)


def table(df: pd.DataFrame, columns: Sequence[tuple[str, str, int]]) -> list[str]:
    """Lines of a table: (column, head, digits); digits under 0 for text."""
    cells = [[head for _, head, _ in columns]]
    for _, row in df.iterrows():
        cells.append([(str(row[c]) if _known(row[c]) else "-") if digits < 0 else shown(row[c], digits) for c, _, digits in columns])
    wide = [max(len(line[k]) for line in cells) for k in range(len(columns))]
    pad = lambda text, k: text.ljust(wide[k]) if columns[k][2] < 0 else text.rjust(wide[k])
    return ["  " + "  ".join(pad(text, k) for k, text in enumerate(line)).rstrip() for line in cells]


CORE = [("label", "series", -1), ("quote_yield", "quote", 2), ("last_trade_yield", "traded", 2), ("expected_yield", "deal", 2), ("residual_bp", "resid", 1), ("dislocation_bp", "gap", 1), ("zscore", "z", 1), ("cost_bp", "b/o", 0), ("carry_bp", "carry", 0), ("roll_bp", "roll", 0), ("per_duration_bp", "per dur", 0), ("bn", "Rs bn", 1), ("days_traded", "days", 0), ("days_since_auction", "auction", 0), ("bid_to_cover", "cover", 1)]
OTHERS = [("side", "side", -1), ("label", "series", -1), ("quote_yield", "quote", 2), ("expected_yield", "deal", 2), ("residual_bp", "resid", 1), ("dislocation_bp", "gap", 1), ("zscore", "z", 1), ("cost_bp", "b/o", 0), ("bn", "Rs bn", 1), ("days_traded", "days", 0)]
SWITCHES = [("buy", "buy", -1), ("sell", "sell", -1), ("gap_bp", "gap", 1), ("zscore", "z", 1), ("cost_bp", "cost", 0), ("capture_bp", "exp", 1), ("verdict", "verdict", -1)]
SHAPE = [("pair", "pair", -1), ("spread_bp", "today", 0), ("change_20d_bp", "20d", 0), ("low_bp", "low", 0), ("high_bp", "high", 0), ("verdict", "verdict", -1)]


def _with_levels(rows: pd.DataFrame, d: Day) -> pd.DataFrame:
    out = rows.assign(bn=rows["turnover_lkr"].astype(float) / 1e9)
    for extra, columns in ((d.forecast, ["quote_yield", "expected_yield"]), (d.carry, ["carry_bp", "roll_bp", "per_duration_bp"])):
        out = out.merge(extra[["isin", *columns]], on="isin", how="left")
    return out


def report(d: Day) -> str:
    """The text report of a day."""
    t = d.tiles
    lines = [f"Government bond relative value, {d.day}", f"curve: {int(t['n_quotes'])} bonds, fit error {shown(t['rmse_bp'])}bp"]
    if _known(t.get("checked_on")):
        lines.append(f"against executed trades: bias {shown(t['trade_bias_bp'], 1, True)}bp over {int(t['checked_trades'])} trades on {t['checked_on']}" + (f" ({int(t['age_days'])}d ago)" if t["age_days"] else ""))
        if t["stale"]:
            lines.append(f"  !! that check is {int(t['age_days'])} days old")
    else:
        lines.append("against executed trades: never checked")
    lines += [f"execution: {describe_gap(d.gap_bp)}", describe_forecast(d.forecast)]
    if d.funding:
        lines.append(f"funding: {shown(d.funding['rate_pct'], 2)}%, the 12-month bill of {shown(d.funding['bill_pct'], 2)}% and 5bp")
    lines += ["", f"CORE BOOK: {len(d.core)} benchmarks that trade, cheapest first"]
    lines += table(_with_levels(d.core, d), CORE) if len(d.core) else ["  none today"]
    if len(d.waiting):
        lines += ["", "NOT SCORED YET: they trade, but their history is short"] + [f"  {row.label}: {describe_liquidity(row)}; {int(row.days)} quote days so far" for _, row in d.waiting.iterrows()]
    if len(d.others):
        lines += ["", "ALSO TRADING: the cheap and the rich end"] + table(_with_levels(d.others, d), OTHERS)
    if len(d.switches):
        lines += ["", "SWITCHES: both legs in the core book"] + table(d.switches, SWITCHES)
    if len(d.shape):
        lines += ["", "CURVE SHAPE: the long point less two years, bp"] + table(d.shape, SHAPE)
    if t["hidden_scored"]:
        lines += ["", f"{int(t['hidden_scored'])} scored bonds are not shown: quoted too wide, or trading too seldom"]
    return "\n".join(lines) + "\n"


def ticks(low: float, high: float, count: int = 6) -> list[float]:
    """Round values that cover low to high in about ``count`` steps of 1, 2 or 5."""
    if not high > low:
        high = low + 1
    raw = (high - low) / count
    size = 10 ** math.floor(math.log10(raw))
    step = next(size * k for k in (1, 2, 5, 10) if size * k >= raw * (1 - 1e-9))
    first = math.floor(low / step + 1e-9)
    return [round(k * step, 10) for k in range(first, math.ceil(high / step - 1e-9) + 1)]


WIDTH, HEIGHT, EDGE = 880, 400, 48


def chart(series: Sequence[tuple[str, str, Sequence[tuple[float, float]]]], x_name: str, y_name: str) -> str:
    """An SVG of series (name, ``line``, ``dots`` or ``rings``, points)."""
    points = [p for _, _, s in series for p in s if _known(p[0]) and _known(p[1])]
    if not points:
        return f'<svg viewBox="0 0 {WIDTH} {HEIGHT}" role="img"><text x="20" y="30">no data</text></svg>'
    xs, ys = ticks(min(p[0] for p in points), max(p[0] for p in points)), ticks(min(p[1] for p in points), max(p[1] for p in points))
    at_x = lambda v: EDGE + (v - xs[0]) / (xs[-1] - xs[0]) * (WIDTH - 2 * EDGE)
    at_y = lambda v: HEIGHT - EDGE - (v - ys[0]) / (ys[-1] - ys[0]) * (HEIGHT - 2 * EDGE)
    out = [f'<svg viewBox="0 0 {WIDTH} {HEIGHT}" role="img" font-family="sans-serif" font-size="11">']
    out += [f'<line x1="{EDGE}" x2="{WIDTH - EDGE}" y1="{at_y(v):.1f}" y2="{at_y(v):.1f}" stroke="#ddd"/><text x="{EDGE - 6}" y="{at_y(v) + 4:.1f}" text-anchor="end">{v:g}</text>' for v in ys]
    out += [f'<text x="{at_x(v):.1f}" y="{HEIGHT - EDGE + 16}" text-anchor="middle">{v:g}</text>' for v in xs]
    out += [f'<text x="{WIDTH / 2}" y="{HEIGHT - 8}" text-anchor="middle">{html.escape(x_name)}</text><text x="12" y="20">{html.escape(y_name)}</text>']
    for k, (name, kind, s) in enumerate(series):
        colour = ("#1b4f72", "#b9770e", "#1e8449", "#922b21")[k % 4]
        good = [(at_x(a), at_y(b)) for a, b in s if _known(a) and _known(b)]
        if kind == "line":
            out.append(f'<polyline fill="none" stroke="{colour}" stroke-width="2" points="{" ".join(f"{a:.1f},{b:.1f}" for a, b in good)}"><title>{html.escape(name)}</title></polyline>')
        else:
            fill = colour if kind == "dots" else "none"
            out += [f'<circle cx="{a:.1f}" cy="{b:.1f}" r="4" fill="{fill}" stroke="{colour}"><title>{html.escape(name)}</title></circle>' for a, b in good]
        out.append(f'<text x="{WIDTH - EDGE}" y="{20 + 14 * k}" text-anchor="end" fill="{colour}">{html.escape(name)}</text>')
    return "".join([*out, "</svg>"])


def curve_chart(d: Day) -> str:
    """A day's quotes, its curve, and prints carried forward, drawn open."""
    c = d.curve.sort_values("tau")
    return chart([("curve", "line", list(zip(c.tau, c.fitted))), ("quotes", "dots", list(zip(c.tau, c.mid))), ("carried trades", "rings", list(zip(d.carried.tau, d.carried.last_trade_yield)))], "years to maturity", "yield, percent")


def history_chart(history: pd.DataFrame) -> str:
    """One bond's bid, offer and traded yields over days."""
    h = history.sort_values("obs_date")
    day = [pd.Timestamp(x).toordinal() for x in h.obs_date]
    origin = day[0] if day else 0
    day = [x - origin for x in day]
    return chart([("bid", "line", list(zip(day, h.bid))), ("offer", "line", list(zip(day, h.offer))), ("traded", "dots", list(zip(day, h.traded)))], "days", "yield, percent")


def _html_table(df: pd.DataFrame, columns: Sequence[tuple[str, str, int]], bars: bool = False) -> str:
    head = "".join(f"<th>{html.escape(name)}</th>" for _, name, _ in columns) + ("<th></th>" if bars else "")
    rows = []
    for _, row in df.iterrows():
        cells = "".join(f"<td>{html.escape(str(row[c]) if _known(row[c]) else '-')}</td>" if digits < 0 else f"<td class=n>{shown(row[c], digits)}</td>" for c, _, digits in columns)
        bar = f'<td><div class="bar {row["side"]}"><span style="width:{row["bar_pct"]:.1f}%"></span></div></td>' if bars else ""
        rows.append(f"<tr>{cells}{bar}</tr>")
    return f"<table><tr>{head}</tr>{''.join(rows)}</table>"


STYLE = "body{font-family:sans-serif;max-width:60em;margin:1em auto}table{border-collapse:collapse;width:100%}td,th{padding:2px 6px;border-bottom:1px solid #eee;text-align:left}.n{text-align:right}.tile{display:inline-block;margin:0 1.5em 1em 0}.tile b{display:block;font-size:1.6em}.bar{position:relative;height:8px;background:#f4f4f4}.bar span{position:absolute;height:8px}.cheap span{left:50%;background:#1e8449}.rich span{right:50%;background:#922b21}"


def page(d: Day, fragment: bool = False) -> str:
    """The page of a day, with nothing that is fetched from elsewhere. ``fragment`` leaves out
    the document around it."""
    t = d.tiles
    checked = f"{shown(t.get('trade_bias_bp'), 0, True)}bp" if _known(t.get("checked_on")) else "-"
    note = "no trades recorded yet" if not _known(t.get("checked_on")) else f"{int(t['checked_trades'])} trades on {t['checked_on']}" + (f", {int(t['age_days'])} days stale" if t["stale"] else f", {int(t['age_days'])}d ago" if t["age_days"] else "")
    tiles = [("fit error", f"{shown(t['rmse_bp'])}bp", f"{int(t['n_quotes'])} bonds"), ("against trades", checked, note), ("core turnover", f"{t['core_turnover_lkr'] / 1e9:.0f}bn", f"{int(t['n_core'])} bonds"), ("funding", shown(d.funding.get("rate_pct"), 2, unit="%"), "12-month bill and 5bp" if d.funding else "no recent bill print"), ("gap", shown(d.gap_bp, 0, True, "bp"), describe_gap(d.gap_bp))]
    parts = [f"<h1>{d.day}</h1>", "".join(f'<div class="tile">{html.escape(name)}<b>{value}</b>{html.escape(note)}</div>' for name, value, note in tiles), curve_chart(d), f"<p>{html.escape(str(t['no_print']))}</p>"]
    parts += ["<h2>Core book</h2>", _html_table(_with_levels(d.core, d), CORE, True) if len(d.core) else "<p>none today</p>"]
    if len(d.waiting):
        parts += ["<h2>Not scored yet</h2><ul>", "".join(f"<li>{html.escape(str(r.label))}: {html.escape(describe_liquidity(r))}; {int(r.days)} quote days</li>" for _, r in d.waiting.iterrows()), "</ul>"]
    if len(d.others):
        parts += ["<h2>Also trading</h2>", _html_table(_with_levels(d.others, d), OTHERS, True)]
    if len(d.switches):
        parts += ["<h2>Switches</h2>", _html_table(d.switches, SWITCHES)]
    if len(d.shape):
        parts += ["<h2>Curve shape</h2>", _html_table(d.shape, SHAPE)]
    if t["hidden_quoted"]:
        parts.append(f"<p>{int(t['hidden_quoted'])} quoted bonds are not shown: too wide, or trading too seldom.</p>")
    body = "\n".join(parts)
    return body if fragment else f'<!doctype html><html lang="en"><head><meta charset="utf-8"><title>{d.day}</title><style>{STYLE}</style></head><body>\n{body}\n</body></html>\n'


def history(df: DataFrame, isin: str, tail: int = 20) -> pd.DataFrame:
    """The last ``tail`` days of one bond, oldest first."""
    return df.where(F.col("isin") == isin).orderBy(F.desc("obs_date")).limit(tail).toPandas().sort_values("obs_date")
