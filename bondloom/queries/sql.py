"""Common parts of the SQL that the queries are checked against."""

from __future__ import annotations

from bondloom.plans.curve import GRID


def rounded(*columns: str, digits: int = 4) -> str:
    return ", ".join(f"round({c}, {digits}) + 0 as {c}" for c in columns)


_SOLVE = """
s0*(s11*s22-s12*s12) - s1*(s1*s22-s12*s2) + s2*(s1*s12-s11*s2) det,
(y0*(s11*s22-s12*s12) - s1*(y1*s22-s12*y2) + s2*(y1*s12-s11*y2)) / det beta0,
(s0*(y1*s22-s12*y2) - y0*(s1*s22-s12*s2) + s2*(s1*y2-y1*s2)) / det beta1,
(s0*(s11*y2-y1*s12) - s1*(s1*y2-y1*s2) + y0*(s1*s12-s11*s2)) / det beta2"""

_SUMS = """count(*) n, sum(weight) s0, sum(weight*f1) s1, sum(weight*f2) s2, sum(weight*f1*f1) s11, sum(weight*f1*f2) s12, sum(weight*f2*f2) s22,
sum(weight*mid) y0, sum(weight*f1*mid) y1, sum(weight*f2*mid) y2, sum(weight*mid*mid) yy"""


def _load(tau: str, lam: str) -> str:
    return f"(1 - exp(-{tau}/{lam})) / ({tau}/{lam})"


def _fitted(tau: str) -> str:
    f = _load(tau, "2.5e0")
    return f"beta0 + beta1 * {f} + beta2 * ({f} - exp(-{tau}/2.5e0))"


#: Parts that are not used are not run.
BASE = rf"""with
bq as (select obs_date, isin, arg_max(struct_pack(b := bid_yield, o := offer_yield, m := mid_yield), obs_seq) r
  from observations where source = 'pdmo_daily' and (bid_yield is not null or offer_yield is not null) group by 1, 2),
bd as (select * from bonds where maturity_date is not null and coalesce(len(regexp_extract_all(series_label, '\d+(?:\.\d+)?\s*%')), 0) <= 1),
q as (select obs_date, isin, date_diff('day', obs_date, maturity_date) / 365.25e0 tau, r.b bid, r.o offer, r.m mid, (r.b - r.o) * 100 spread_bp
  from bq join bd using (isin) where r.m is not null and date_diff('day', obs_date, maturity_date) / 365.25e0 >= 0.08e0),
tv as (select obs_date, isin, arg_max(struct_pack(s := security_type, y := wavg_yield, v := volume_lkr, n := n_trades), trade_seq) r from trade_summary group by 1, 2),
t as (select obs_date, isin, date_diff('day', obs_date, maturity_date) / 365.25e0 tau, r.y traded, r.v volume_lkr, r.n n_trades
  from tv join bd using (isin) where r.s = 'TBond' and r.y is not null and date_diff('day', obs_date, maturity_date) / 365.25e0 >= 0.08e0),
w1 as (select *, greatest(1, least(300, coalesce(abs(spread_bp), median(abs(spread_bp)) over (partition by obs_date), 20))) s from q),
w as (select *, (1 / (s * s)) / avg(1 / (s * s)) over (partition by obs_date) weight from w1),
wf as (select *, {_load('tau', '2.5e0')} f1, {_load('tau', '2.5e0')} - exp(-tau/2.5e0) f2 from w),
sm as (select obs_date, {_SUMS} from wf group by 1),
bt as (select obs_date, n, s0 * s11 * s22 dd, {_SOLVE} from sm where n >= 6),
res as (select w.*, n, beta0, beta1, beta2, {_fitted('tau')} fitted, (mid - ({_fitted('tau')})) * 100 residual_bp from w join bt using (obs_date) where abs(det) > 1e-12 * dd),
fit as (select obs_date, any_value(beta0) beta0, any_value(beta1) beta1, any_value(beta2) beta2, count(*) n_quotes,
  sqrt(sum(weight * (residual_bp / 100) * (residual_bp / 100)) / sum(weight)) * 100 rmse_bp from res group by 1),
tr as (select t.*, (traded - ({_fitted('tau')})) * 100 residual_bp from t join fit using (obs_date)),
chk as (select obs_date, count(*) n_trades, sqrt(avg(residual_bp * residual_bp)) trade_rmse_bp, median(residual_bp) trade_bias_bp from tr group by 1),
gw as (select obs_date, mid, weight, lam, {_load('tau', 'lam')} f1, {_load('tau', 'lam')} - exp(-tau/lam) f2 from w, (select unnest([{', '.join(repr(x) for x in GRID)}]::double[]) lam)),
g1 as (select obs_date, lam, weight w, count(*) over g n, f1 - sum(weight * f1) over g / sum(weight) over g c1, f2 - sum(weight * f2) over g / sum(weight) over g c2,
  mid - sum(weight * mid) over g / sum(weight) over g cy from gw window g as (partition by obs_date, lam)),
g2 as (select obs_date, lam, w, n, c2 - c1 * sum(w * c1 * c2) over g / sum(w * c1 * c1) over g d2, cy - c1 * sum(w * c1 * cy) over g / sum(w * c1 * c1) over g dy from g1 where n >= 6 window g as (partition by obs_date, lam)),
g3 as (select obs_date, lam, w, dy - case when sum(w * d2 * d2) over g > 1e-28 * sum(w) over g then d2 * sum(w * d2 * dy) over g / sum(w * d2 * d2) over g else 0 end e from g2 window g as (partition by obs_date, lam)),
gday as (select obs_date, lam, sum(w * e * e) rss from g3 group by 1, 2),
grid as (select lam, sum(rss) rss, count(*) as n_days from gday group by 1),
z1 as (select obs_date, isin, tau, residual_bp, count(*) over p n_window, avg(residual_bp) over p m, stddev_samp(residual_bp) over p s from res
  window p as (partition by isin order by obs_date rows between 60 preceding and 1 preceding)),
z as (select obs_date, isin, tau, residual_bp, n_window, case when n_window >= 30 then m end mean_bp, case when n_window >= 30 then s end sd_bp,
  case when n_window >= 30 then residual_bp - m end dislocation_bp, case when n_window >= 30 and s > 0.5e0 then (residual_bp - m) / s end zscore from z1),
mt as (select isin, median(tau) tau from res group by 1),
ever as (select distinct isin from auctions),
pr as (select a.isin isin_a, b.isin isin_b, a.tau tau_a, b.tau tau_b from mt a join mt b on a.isin < b.isin and (abs(a.tau - b.tau) <= 2 or (a.isin in (select isin from ever where isin is not null) and b.isin in (select isin from ever where isin is not null)))),
ps as (select a.obs_date, isin_a, isin_b, a.residual_bp - b.residual_bp spread_bp from pr join res a on a.isin = isin_a join res b on b.isin = isin_b and a.obs_date = b.obs_date),
sz1 as (select *, count(*) over p n_window, avg(spread_bp) over p m, stddev_samp(spread_bp) over p s from ps
  window p as (partition by isin_a, isin_b order by obs_date rows between 60 preceding and 1 preceding)),
sz as (select obs_date, isin_a, isin_b, spread_bp, n_window, (spread_bp - m) / s zscore from sz1 where n_window >= 30 and s > 0.5e0)"""

#: Price, first moment and roll at an entry yield; null at yields of -200 percent and less.
def _flows(y: str) -> str:
    flow = f"(coupon_pct / 2 + case when x >= tau - 1e-9 then 100 else 0 end) / (1 + {y} / 200) ** (2 * x)"
    return f"case when {y} > -200 then list_sum(list_transform(tm, lambda x: {flow})) end price, case when {y} > -200 then list_sum(list_transform(tm, lambda x: x * {flow})) end mo"


_ROLL = f"duration * (({_fitted('p.tau')}) - ({_fitted('greatest(p.tau - 0.25e0, 0.02e0)')})) * 100 / 0.25e0"

_P2 = "(select * from pt where point = 2)"

#: Further parts: shape, market, dealing.
MARKET = rf""",
pw as (select obs_date, point, tau, residual_bp, spread_bp, case when abs((tau - point) / 0.75e0) <= 3 then coalesce(weight, 1) * exp(-0.5e0 * ((tau - point) / 0.75e0) ** 2) else 0 end k
  from res, (select unnest([2e0, 5e0, 8e0, 10e0, 12e0]) point)),
px as (select obs_date, point, sum(k) k, sum(k * residual_bp) kr, median(spread_bp) filter (abs(tau - point) <= 1) / 2 half_bp from pw group by 1, 2),
pt as (select obs_date, point, {_fitted('point')} curve_yield, {_fitted('point')} + case when k > 0 then kr / k / 100 else 0 end point_yield, half_bp from px join fit using (obs_date)),
cs as (select l.obs_date, '2s' || cast(l.point as int) || 's' pair, (l.point_yield - s.point_yield) * 100 spread_bp, (l.curve_yield - s.curve_yield) * 100 curve_only_bp, l.half_bp + s.half_bp cost_bp
  from pt l join {_P2} s using (obs_date) where l.point > 2),
cz1 as (select *, count(*) over p c, avg(spread_bp) over p m, stddev_samp(spread_bp) over p s from cs window p as (partition by pair order by obs_date rows between 60 preceding and 1 preceding)),
cz as (select obs_date, pair, spread_bp, curve_only_bp, cost_bp, case when c >= 30 and s > 0.5e0 then (spread_bp - m) / s end zscore from cz1),
cf as (select *, lead(spread_bp, 11) over p - lead(spread_bp, 1) over p fwd from cz window p as (partition by pair order by obs_date)),
cr as (select pair, count(*) n, case when count(*) >= 20 then avg(-sign(zscore) * fwd) end reversion_bp from cf where abs(zscore) >= 1.5e0 and fwd is not null group by 1),
sd as (select obs_date d from fit),
av as (select auction_date, isin, kind, r.* from (select auction_date, isin, kind, arg_max(struct_pack(offered := offered_lkr, bids := bids_lkr), auction_seq) r from auctions group by 1, 2, 3)),
tb as (select obs_date, isin, r.y y, r.v v, r.n n from tv where r.s = 'TBond'),
th as (select d, coalesce(max(obs_date), d) thr from sd left join tb on obs_date <= d and d - obs_date <= 7 group by d),
fl as (select d, isin, coalesce(sum(v), 0) tu, coalesce(sum(n), 0) nt, count(*) dt from th join tb on obs_date <= thr and obs_date > thr - 60 group by 1, 2),
so as (select d, isin, min(d - auction_date) ds from sd join av on auction_date <= d and auction_date >= d - 120 group by 1, 2),
kn as (select d, isin, d - max(obs_date) dl, arg_max(y, obs_date) yl from sd join tb on obs_date <= d where y is not null group by 1, 2),
cv as (select d, isin, arg_max(bids / offered, auction_date) bc from sd join av on auction_date <= d where kind = 'auction' and bids is not null and offered > 0 group by 1, 2),
ke as (select d, isin from fl union select d, isin from so union select d, isin from kn),
liq as (select ke.d asof_day, ke.isin, cast(coalesce(tu, 0) as bigint) turnover_lkr, cast(coalesce(nt, 0) as bigint) n_trades, coalesce(dt, 0) days_traded, ds is not null is_benchmark, cast(ds as int) days_since_auction,
  coalesce(ds <= 14, false) post_auction, bc bid_to_cover, cast(dl as int) days_since_trade, yl last_trade_yield,
  case when ds is not null and coalesce(dt, 0) >= 8 then 'core' when coalesce(dt, 0) >= 10 then 'active' else 'wider' end tier
  from ke left join fl using (d, isin) left join so using (d, isin) left join kn using (d, isin) left join cv using (d, isin)),
bl as (select obs_date, r.y y, r.v v, make_date(2000 + cast(substr(isin, 7, 2) as int), ascii(substr(isin, 9, 1)) - 64, cast(substr(isin, 10, 2) as int)) - obs_date rem
  from tv where r.s = 'Tbill' and r.y is not null and r.v > 0 and isin like 'LKA%'),
bs as (select d, obs_date, y, v from sd join bl on obs_date <= d and obs_date > d - 30 where rem between 240 and 380),
bn as (select *, max(obs_date) over (partition by d) mx from bs),
fund as (select d asof_day, sum(y * v) / sum(v) bill_pct, cast(d - any_value(mx) as int) stale_days, count(*) n_bills from bn where obs_date > mx - 5 group by d),
pf as (select q.obs_date, q.isin, q.tau, q.mid, coupon_pct, list_filter(list_transform(range(0, greatest(cast(ceil(2 * tau - 1e-9) as int), 1)), lambda k: tau - k / 2e0), lambda x: x > 1e-9) tm
  from q join bonds using (isin) where coupon_pct is not null),
pd as (select obs_date, isin, tau, mid, price, mo / price / (1 + mid / 200) duration from (select *, {_flows('mid')} from pf)),
gp as (select r.obs_date, r.isin, r.tau, t.traded, (t.traded - r.mid) * 100 gap_bp from res r join t using (obs_date, isin)),
di as (select obs_date, row_number() over (order by obs_date) - 1 idx from (select distinct obs_date from res)),
gx as (select gp.*, idx from gp join di using (obs_date)),
mk1 as (select di.idx, count(*) filter (di.idx - g.idx < 2) n2, median(gap_bp) filter (di.idx - g.idx < 2) g2, count(*) filter (di.idx - g.idx < 5) n5, median(gap_bp) filter (di.idx - g.idx < 5) g5, count(*) n20, median(gap_bp) g20
  from di join gx g on g.idx <= di.idx and g.idx > di.idx - 20 group by 1),
mk as (select idx, case when n2 >= 5 then g2 when n5 >= 5 then g5 when n20 >= 5 then g20 end market_bp, case when n2 >= 5 then 2 when n5 >= 5 then 5 when n20 >= 5 then 20 end market_rows, g20 old_bp from mk1),
bk1 as (select t.isin, t.obs_date, a.idx - lag idx, lag, (t.traded - r.mid) * 100 missed from t join di a using (obs_date) join di b on b.idx = a.idx - 1 join res r on r.obs_date = b.obs_date and r.isin = t.isin, (values (1), (2)) v(lag) where a.idx >= 60),
bk2 as (select s.*, g.idx gi, g.gap_bp from bk1 s asof left join gx g on s.isin = g.isin and s.idx >= g.idx),
bk3 as (select bk2.*, market_bp, old_bp, bk2.idx - gi own_age, case when gap_bp is null then 0 else 0.5e0 ** ((bk2.idx - gi) / 2e0) end wt,
  coalesce(market_bp + greatest(-40, least(40, gap_bp - market_bp)), 0) own from bk2 join mk on mk.idx = bk2.idx where market_bp is not null),
bk as (select obs_date, isin, lag, missed screen_error, missed - coalesce(old_bp, 0) old_error, missed - market_bp market_error, missed - (wt * own + (1 - wt) * market_bp) error, own_age from bk3),
acc as (select lag, count(*) n, quantile_cont(abs(error), 0.5) band50_bp, quantile_cont(abs(error), 0.8) band80_bp, quantile_cont(abs(screen_error), 0.5) screen_band50_bp from bk group by lag having count(*) >= 100),
ld as (select di.obs_date, di.idx, max(g.idx) lst, max(g.obs_date) through from di join gx g on g.idx <= di.idx group by 1, 2),
fc1 as (select r.obs_date, r.isin, r.mid, ld.lst, ld.through from res r join ld using (obs_date)),
fc2 as (select f.*, g.idx gi, g.gap_bp from fc1 f asof left join gx g on f.isin = g.isin and f.lst >= g.idx),
fc3 as (select f.*, m.market_bp, m.market_rows, f.lst - gi own_age, case when gap_bp is not null then m.market_bp + greatest(-40, least(40, gap_bp - m.market_bp)) end own from fc2 f join mk m on m.idx = f.lst where m.market_bp is not null),
fc as (select obs_date, isin, mid quote_yield, adj adjustment_bp, mid + adj / 100 expected_yield, own own_gap_bp, own_age own_age_days, market_bp market_gap_bp, market_rows market_window, through trades_through, through = obs_date fresh,
  band50_bp, band80_bp, screen_band50_bp from (select *, case when own is null then market_bp else 0.5e0 ** (own_age / 2e0) * own + (1 - 0.5e0 ** (own_age / 2e0)) * market_bp end adj from fc3)
  left join acc on lag = case when through = obs_date then 1 else 2 end),
eg as (select d, count(*) n, case when count(*) >= 8 then median(gap_bp) end gap_bp from sd join gp on obs_date <= d and obs_date > d - 20 group by d),
eb as (select coalesce(d, f.obs_date) asof_day, coalesce(f.m, eg.gap_bp, 0) entry_gap_bp from eg full join (select obs_date, any_value(market_gap_bp) m from fc group by 1) f on f.obs_date = d),
ce as (select pf.*, pf.mid + coalesce(entry_gap_bp, 0) / 100 entry_yield, bill_pct + 0.05e0 rate from pf join fund on asof_day = pf.obs_date left join eb on eb.asof_day = pf.obs_date),
cp as (select *, mo / price / (1 + entry_yield / 200) duration from (select *, {_flows('entry_yield')} from ce)),
car as (select p.obs_date, p.isin, entry_yield, price, duration, (entry_yield - rate) * 100 carry_bp, {_ROLL} roll_bp from cp p join fit using (obs_date))"""
