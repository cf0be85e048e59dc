"""Malformed files and bodies."""

import datetime
import decimal
import random

import pytest

from barloom.operators import quality
from barloom.schemas import CSV_HEADER
from barloom.sources import price_csv

DAY = datetime.date(2024, 1, 2)


def reasons(checked):
    return {row.reason: row.n_rows for row in quality.reason_counts(checked).collect()}


@pytest.fixture
def check_body(spark):
    def check(*bodies):
        payloads = spark.createDataFrame(
            [(f"S{i}", DAY, body) for i, body in enumerate(bodies)],
            "symbol string, fetch_date date, body string",
        )
        return quality.classify(
            price_csv.parse_payloads(payloads), order=["line_no"], fetch=["fetch_date"]
        )

    return check


def body(*lines, header=CSV_HEADER, end="\r\n"):
    return end.join([header, *lines]) + end


GOOD = "2024-01-02,10.00,11.00,9.00,10.50,100"


@pytest.mark.parametrize(
    "line, reason",
    [
        ("2024-01-02,ten,11.00,9.00,10.50,100", {"unparsable": 1}),
        ("2024-01-02,10.00,11.00,9.00,10.50", {"unparsable": 1}),
        ("2024-01-02,10.00,11.00,9.00,10.50,100,7", {"unparsable": 1}),
        ("01/02/2024,10.00,11.00,9.00,10.50,100", {"unparsable": 1}),
        (",10.00,11.00,9.00,10.50,100", {"null_key": 1}),
        ("2024-01-02,10.00,11.00,9.00,,100", {"null_price": 1}),
        (
            "2024-01-02,10.00,9.00,11.00,10.50,100",
            {"high_below_low": 1, "open_out_of_range": 1, "close_out_of_range": 1},
        ),
        ("2024-01-02,10.00,11.00,9.00,12.00,100", {"close_out_of_range": 1}),
        ("2024-01-02,10.00,11.00,9.00,10.50,-1", {"negative_volume": 1}),
        (GOOD, {"accepted": 1}),
    ],
)
def test_line(check_body, line, reason):
    assert reasons(check_body(body(line))) == reason


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_ends(check_body, end):
    assert reasons(check_body(body(GOOD, "2024-01-03,1,1,1,1,1", end=end))) == {"accepted": 2}


def test_cents_are_exact(check_body):
    row = quality.to_bars(quality.accepted(check_body(body("2024-01-02,0.2900,0.5800,0.29,0.5700,3")))).first()
    assert tuple(row)[2:] == (29, 58, 29, 57, 3)


def test_a_price_finer_than_a_cent_is_rejected_not_rounded(check_body):
    assert reasons(check_body(body("2024-01-02,0.2900,0.5800,0.29,0.5750,3"))) == {"sub_cent": 1}
    assert reasons(check_body(body("2024-01-02,10.00001,11,9,10.5,3"))) == {"sub_cent": 1}


def test_error_message_in_place_of_prices(check_body):
    assert reasons(check_body('{"message": "limit reached"}')) == {"bad_header": 1}


def test_missing_header_rejects_the_whole_body(check_body):
    assert reasons(check_body(GOOD + "\n2024-01-03,1,1,1,1,1")) == {"bad_header": 2}


def test_reordered_header_rejects_the_whole_body(check_body):
    assert reasons(check_body(body(GOOD, header="trade_date,close,high,low,open,volume"))) == {"bad_header": 2}


def test_several_headers_are_taken(spark):
    rows = [(body(GOOD, header="day,o,h,l,c,v"),), (body(GOOD),), (body(GOOD, header="a,b,c,d,e,f"),)]
    parsed = price_csv.parse_payloads(spark.createDataFrame(rows, "body string"), (CSV_HEADER, "Day,o,h,l,c,v"))
    assert sorted(row.header_ok for row in parsed.collect()) == [False, False, True, True]


def test_empty_and_header_only(check_body):
    assert reasons(check_body("", None)) == {"bad_header": 2}
    assert reasons(check_body(CSV_HEADER)) == {}


def test_repeated_date_keeps_the_first(check_body):
    second = "2024-01-02,10.00,11.00,9.00,9.50,100"
    checked = check_body(body(GOOD, second, GOOD))
    assert reasons(checked) == {"accepted": 1, "duplicate_key": 2}
    assert quality.to_bars(quality.accepted(checked)).first().close_c == 1050


def test_unsound_first_row_does_not_shadow_a_sound_one(check_body):
    checked = check_body(body("2024-01-02,10.00,11.00,9.00,99.00,100", GOOD))
    assert reasons(checked) == {"accepted": 1, "close_out_of_range": 1}


def test_files(spark, tmp_path):
    """Header handling of files: each has its own, one has none, one another layout."""
    folder = tmp_path / "fetch_date=2024-01-05" / "symbol=A B"
    folder.mkdir(parents=True)
    (folder / "good.csv").write_text(body(GOOD, "2024-01-03,1,1,1,x,1"))
    (folder / "bare.csv").write_text("2024-01-04,1,1,1,1,1\n")
    (folder / "other.csv").write_text("day,o,h,l,c,v\n2024-01-05,1,1,1,1,1\n")
    path = str(tmp_path)

    raw = price_csv.read_prices(spark, path)
    # No first line is lost: the bare file's price is there, the other header is a bad row.
    assert sorted(str(r.trade_date) for r in raw.where("_bad is null").collect()) == [
        "2024-01-02", "2024-01-04", "2024-01-05",
    ]
    assert {r.symbol for r in raw.collect()} == {"A B"}
    assert raw.select("_bad").where("_bad is not null").count() == 2
    faulty = price_csv.files_without_header(price_csv._scan_path(spark, path, CSV_HEADER)).collect()
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in faulty) == ["bare.csv", "other.csv"]
    rows = price_csv.read_checked(spark, path)
    assert "BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()
    checked = quality.classify(rows, ["source_file"], ["fetch_date"])
    assert reasons(checked) == {"accepted": 1, "unparsable": 1, "bad_header": 3}


def test_flat_file_with_another_header(spark, tmp_path):
    header = "timestamp,open,high,low,close,volume"
    (tmp_path / "prices.csv").write_text(body(GOOD, header=header.title()))
    raw = price_csv.read_flat(spark, str(tmp_path / "prices.csv"), "ABC", DAY, header)
    good, rejects = quality.validate(raw, ["source_file"], ["fetch_date"])
    assert [tuple(r) for r in quality.to_bars(good).collect()] == [("ABC", DAY, 1000, 1100, 900, 1050, 100)]
    assert rejects.count() == 0
    # Against the usual header the file does not pass.
    usual = price_csv.read_flat(spark, str(tmp_path / "prices.csv"), "ABC", DAY)
    assert reasons(quality.classify(usual, ["source_file"], ["fetch_date"])) == {"bad_header": 2}


def test_files_that_all_have_headers_are_not_joined(spark, tmp_path):
    folder = tmp_path / "fetch_date=2024-01-05" / "symbol=A"
    folder.mkdir(parents=True)
    (folder / "good.csv").write_text(body(GOOD))
    rows = price_csv.read_checked(spark, str(tmp_path))
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [r.header_ok for r in rows.collect()] == [True]


RAW = (
    "symbol string, trade_date date, open decimal(18,4), high decimal(18,4), low decimal(18,4), "
    "close decimal(18,4), volume bigint, _bad string, line_no int"
)


@pytest.mark.parametrize("salts", [1, 3, 1 << 16])
def test_hot_key_and_copies_against_brute_force(spark, salts):
    """A third of the rows are copies of one, a third share a key, a third are junk with no key."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        rows.append(("HOT", DAY, 5, 5, 5, 5, 1, None, 0))
        rows.append(("KEY", DAY, 5, 5, 5, 5, rng.randint(1, 50), None, rng.randint(1, 40)))
        rows.append((None, None, None, None, None, None, None, "junk", i % 3))
    rows += [(f"S{i}", DAY, 5, 5, 5, 5, 1, None, 0) for i in range(20)]
    rng.shuffle(rows)
    raw = spark.createDataFrame(
        [(r[0], r[1], *[None if v is None else decimal.Decimal(v) for v in r[2:6]], *r[6:]) for r in rows],
        RAW,
    ).repartition(5)

    checked = quality.classify(raw, order=["line_no"], salts=salts)
    assert checked.count() == len(rows)
    assert reasons(checked) == {"accepted": 22, "duplicate_key": 598, "unparsable": 300}
    kept = {r.symbol: (r.line_no, r.volume) for r in quality.accepted(checked).collect()}
    assert kept["KEY"] == min((r[8], r[6]) for r in rows if r[0] == "KEY")
