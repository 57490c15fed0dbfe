import datetime as dt
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from bondloom.functions import codecs
from bondloom.sources import releases, workbook
from bondloom.sources.html import file_id, guarded, index_links, work_order

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def xlsx(**sheets):
    """A workbook of rows of texts, numbers and None; every other text is shared."""
    shared, out = [], io.BytesIO()

    def cell(value, at):
        if value is None:
            return ""
        if isinstance(value, str):
            if at[0] == "A":
                return f'<c r="{at}" t="inlineStr"><is><t>{value}</t></is></c>'
            shared.append(value)
            return f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
        return f'<c r="{at}"><v>{value}</v></c>'

    with zipfile.ZipFile(out, "w") as book:
        for k, rows in enumerate(sheets.values()):
            body = "".join(f'<row r="{i + 1}">' + "".join(cell(v, f"{chr(65 + j)}{i + 1}") for j, v in enumerate(row)) + "</row>" for i, row in enumerate(rows))
            book.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>")
        names = "".join(f'<sheet name="{n.replace("_", " ")}" sheetId="{k + 1}" r:id="r{k}"/>' for k, n in enumerate(sheets))
        book.writestr("xl/workbook.xml", f"<workbook {NS}><sheets>{names}</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        book.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><t>{t}</t></si>" for t in shared) + "</sst>")
    return out.getvalue()


def serial(day):
    return (day - dt.date(1899, 12, 30)).days


def test_quote_sheet(spark):
    menu = [[None], [" DATE OF TRADING", None, serial(dt.date(2026, 11, 12))], [" REPORTING DATE", ":", serial(dt.date(2026, 11, 13))], ["UPDATE", 2.0]]
    quotes = [
        ["note"], ["No", "Series", "Maturity Period (Years)", "Maturity  Date", "Days to Maturity", "Average Buying Price", "Yield", "Average Selling Price", " Yield "],
        ["1", "11.70%2034A", 8, serial(dt.date(2034, 10, 15)), 2893, 98.1, 0.120333, 98.7, 0.119056], ["2", "12.4%7.5%5%2029A", 3, "bad", 852, 0, 0.1, 0, 7.0],
        ["3", "9.00%2025A", 0, serial(dt.date(2025, 1, 1)), 0, 0, 0, 0, 0], ["total", None, 1.0],
    ]
    files = spark.createDataFrame([("a", xlsx(Main_Menu=menu, QuotesTBond=quotes)), ("b", b"<html>"), ("c", None)], "path string, content binary")
    cells = workbook.workbook_cells(files).cache()
    assert [(r["file"], r["error"] is not None) for r in cells.where("error is not null").collect()] == [("b", True)]
    got = workbook.daily_quotes(cells).orderBy("row").collect()
    assert [(r["label"], r["printed_label"], r["coupon"], r["maturity"], r["bid_yield"], r["offer_yield"], r["bid_price"]) for r in got] == [
        ("11.70%2034A", None, 11.7, dt.date(2034, 10, 15), 12.0333, 11.9056, 98.1), ("12.40%7.50%5.00%2029A", "12.4%7.5%5%2029A", 12.4, dt.date(2029, 3, 14), 10.0, None, None),
    ]
    assert (got[0]["reporting"], got[0]["trading"], got[0]["update"]) == (dt.date(2026, 11, 13), dt.date(2026, 11, 12), 2.0)
    assert workbook.daily_quotes(cells.limit(0)).count() == 0


def test_volume_sheet_goes_by_its_data_not_its_title(spark):
    rows = [["Volumes on 12.18.2025"], ["No", "isin ", "Maturity", "Remaining", "Amount"], ["1", "LKB00426E154", 1, 147 / 365, 495], ["2", " lkb00934f154 ", 1, 3100 / 365, 5.5], ["3", "LKB00934F155", 1, 1, 5], ["4", "LKB00426E154", 1, 1, "x"], ["", "Total", 1, 1, 500]]
    got = workbook.traded_volumes(workbook.workbook_cells(spark.createDataFrame([("v", xlsx(S=rows))], "path string, content binary"))).collect()
    assert {(r["obs_date"], r["isin"].strip(), r["volume_lkr"]) for r in got} == {(dt.date(2025, 12, 19), "LKB00426E154", 495_000_000), (dt.date(2025, 12, 19), "lkb00934f154", 5_500_000)}


def test_trade_report(spark):
    body = [["No", None, "ISIN", None], ["1LKA36426K135", "", "364", "Tbill", "8.9", "8.91", "9.1", "8.8", "8.97", "2 ,800", "5"], ["2", "LKB00934F154", "9", "TBond", "1", "2"], ["Total", "1"], ["1\n2", "LKB00934F154\nLKA36427H279", "9\n364", "TBond\nTbill", *["10.5\n9.5"] * 5, "100\n1,250.5", "3\n4", None]]
    tables = spark.createDataFrame([("f", 0, k, c) for k, c in enumerate(body)] + [("f", 1, 0, ["LKB00934F154"])], "file string, tab int, row int, cells array<string>")
    texts = spark.createDataFrame([("f", "Report Trade Summary - 15.09.2026 x", dt.date(2026, 10, 15))], "file string, text string, label_day date")
    got = {(r["isin"], r["security_type"], r["close_yield"], r["wavg_yield"], r["volume_lkr"], r["n_trades"], r["obs_date"].month) for r in releases.trade_rows(tables, texts).collect()}
    assert got == {("LKA36426K135", "Tbill", 8.91, 8.97, 2_800_000_000, 5, 10), ("LKB00934F154", "TBond", 10.5, 10.5, 100_000_000, 3, 10), ("LKA36427H279", "Tbill", 9.5, 9.5, 1_250_500_000, 4, 10)}


@pytest.mark.parametrize(
    "text,label,day",
    [
        ("Trade Summary - 15.09.2026", dt.date(2026, 10, 15), dt.date(2026, 10, 15)), ("Trade Summary: 29.01.2026", dt.date(2026, 1, 26), dt.date(2026, 1, 29)), ("Trade Summary 12.18.2025", None, dt.date(2025, 12, 18)),
        ("Trade Summary 05.06.2026", dt.date(2026, 5, 6), dt.date(2026, 5, 6)), ("of 28 August 2026", dt.date(2026, 8, 1), dt.date(2026, 8, 28)), ("none", dt.date(2026, 8, 1), dt.date(2026, 8, 1)), ("none", None, None),
    ],
)
def test_report_day(spark, text, label, day):
    df = spark.createDataFrame([(text, label)], "t string, d date")
    assert df.select(codecs.report_day(F.col("t"), F.col("d"))).first()[0] == day


def test_releases(spark):
    table = [["", "Series", "", "09.50%2030 ’A’", "", "11.70%2034A"], ["ISIN", "", "LKB00530C017", "", "", "LKB00934F154"], ["of", "bond", ""], ["Coupon Rate", "", ""], ["", "", "", "9.50", "11.70"], ["(p.a.) (%)", "", ""], ["Bids Received", "", "1,230.5", "", "", "20"], ["Weighted Average Yield", "", "9.74", "", "Rejected"]]
    notice = [["Series", "10.00%2030A"], ["", "LKB00530H016"], ["Amount offered", "Rs. 30,000 million"], ["Date of issue", "01 August 2025"], ["Dates of coupon payment", "01 February & 01 August"], ["Accrued Interest", "Rs. 0.8424 per Rs.100"]]
    tables = spark.createDataFrame([("t", 1, k, c) for k, c in enumerate(table)] + [("n", 0, k, c) for k, c in enumerate(notice)], "file string, tab int, row int, cells array<string>")
    prose = "TREASURY BOND ISSUANCE of 30 July 2026\nLKB00530C017 and LKB00934F154, LKB00934F154 at the Weighted Average\nYield Rates of 10.54% and 11.70%, LKB00934F155."
    texts = spark.createDataFrame([("t", "x\nTREASURY BOND AUCTION HELD ON 12 January 2026\nThe date of\nsettlement is 16 January 2026."), ("p", prose), ("z", "nothing"), ("n", "ISSUE OF RS 30,000 MILLION TREASURY BONDS an auction on August 25, 2026 Date of settlement Tuesday, 01 September 2026")], "file string, text string")
    got = {(r["file"], r["isin"]): r for r in releases.auction_results(tables, texts).collect()}
    a = got["t", "LKB00530C017"]
    assert (a["kind"], a["auction_date"], a["settlement_date"], a["series_label"], a["coupon_pct"], a["bids_lkr"], a["way_pct"]) == ("auction", dt.date(2026, 1, 12), dt.date(2026, 1, 16), "9.50%2030A", 9.5, 1_230_500_000, 9.74)
    assert (got["t", "LKB00934F154"]["way_pct"], got["t", "LKB00934F154"]["maturity_date"]) == (None, dt.date(2034, 6, 15))
    assert [(got["p", i]["kind"], got["p", i]["way_pct"]) for i in ("LKB00530C017", "LKB00934F154")] == [("issuance", 10.54), ("issuance", 11.7)]
    assert got["z", None]["error"] and len(got) == 6
    n = {r["file"]: r for r in releases.auction_notices(tables, texts).collect()}
    assert n["t"]["error"] and (n["n"]["auction_date"], n["n"]["settlement_date"], n["n"]["issue_date"]) == (dt.date(2026, 8, 25), dt.date(2026, 9, 1), dt.date(2025, 8, 1))
    assert (n["n"]["isin"], n["n"]["offered_lkr"], n["n"]["coupon_dates"], n["n"]["accrued_per_100"], n["n"]["series_label"]) == ("LKB00530H016", 30_000_000_000, "02-01,08-01", 0.8424, "10.00%2030A")


PAGES = [
    ("d", "daily", """<script>{"x": "<p><a href='/api/file/zz'>Outright</a></p>"}</script><div class="a page-template--body__content"><p>&gt; 26.01.202 6 <a href="/api/file/1">O utright as at </a><a href="/api/file/1">19.12.2025</a>
     <a href="/api/file/2">Amended Daily Summary Repor</a><a href="/api/file/3"></a><a href="/other">Outright</a></p><p>27.01.2026 <a href="/api/file/3">Daily Summary Report</a><a href="/api/file/1">Outright 01.01.2020</a></p></div>"""),
    ("t", "trade-summary", "<div><span>28 August 2026</span><b><a href='/api/file/4/'>Download</a></b></div><a href='https://x/api/file/5'>Trade Summary - 27 August 2026</a><a href='/api/file/4/'></a>"),
    ("a", "bond-auction", "<p>&gt; 31.08.2026 <a href='/api/file/6'>Auction of 27 August 2026 | English</a> <a href='/api/file/7'>27 August 2026 | Tamil</a></p>"),
    ("n", "bond-issuance", "<ul><li>Announcement 20 August 2026 <i><a href='/api/file/8'>English</a></i><a href='/api/file/9'>Tamil</a></li></ul>"), ("x", "daily", None), ("y", "else", "<p>"), ("z", "daily", ""),
]


def test_index_pages(spark):
    links = index_links(spark.createDataFrame(PAGES, "page string, section string, html string"), base="https://x").cache()
    got = {file_: tuple(r) for r in links.select(file_id(F.col("href")).alias("f"), "kind", "label_day", "posted_day", "amended").collect() for file_ in [r["f"]]}
    day = lambda m, d, y=2026: dt.date(y, m, d)
    assert got == {
        "1": ("1", "volumes", day(12, 19, 2025), day(1, 26), False), "2": ("2", "daily_summary", None, day(1, 26), True), "3": ("3", "daily_summary", None, day(1, 27), False), "4": ("4", "trade_summary", day(8, 28), None, False),
        "5": ("5", "trade_summary", day(8, 27), None, False), "6": ("6", "bond_auction", day(8, 27), day(8, 31), False), "8": ("8", "bond_issuance", day(8, 20), None, False),
    }
    done = spark.createDataFrame([("https://x/api/file/6", "ok"), ("https://x/api/file/8", "failed")], "url string, parse_status string")
    assert [r["file_id"] for r in work_order(links, done).orderBy("ingest_seq").collect()] == ["8", "1", "5", "4", "2", "3"]
    assert work_order(links, done, only_new=False).count() == 7


def test_challenge_pages_are_refused(spark):
    rows = [(1, b"x sucuri_cloudproxy", 200), (2, b"PK" + b"sucuri_cloudproxy" + b"0" * 9000, 200), (3, b"fine", 200), (4, b"fine", 307)]
    files = spark.createDataFrame(rows, "id int, content binary, status int")
    assert {r["id"] for r in guarded(files).collect()} == {2, 3, 4} and {r["id"] for r in guarded(files, status="status").collect()} == {2, 3}
    assert guarded(files).where("id = 3").first()["sha256"] == hashlib.sha256(b"fine").hexdigest()
