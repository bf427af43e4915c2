"""Raw scans (S1/S2) on a generated pipe file, and the typed projection."""

import os
import tempfile

from claimlens.operators import clean as C
from claimlens.sources import io as IO

COLS = ["PolicyID", "TransactionMonth", "IsVATRegistered", "TotalPremium"]


def _write(lines):
    d = tempfile.mkdtemp(prefix="claimlens-test-")
    p = os.path.join(d, "raw.txt")
    with open(p, "wb") as f:
        f.write(("\n".join(lines) + "\n").encode("utf-8"))
    return p


def test_tolerant_scan(spark):
    p = _write(["|".join(COLS), "", "1|2015-03-01 00:00:00|True|21.9", "2|2015-04-01 00:00:00|False",
                "3|2015-05-01 00:00:00|True|1|extra", '4|"a|b"|yes|.000000000000', "1|2015-03-01 00:00:00|True|21.9"])
    df = IO.read_raw_tolerant(spark, p, columns=COLS)
    rows = {r.PolicyID: r for r in df.collect()}
    assert set(rows) == {"1", "2", "4"}            # the over-long line is dropped, the blank line skipped
    assert rows["2"].TotalPremium is None          # the short line is kept, null-padded
    assert rows["4"].TransactionMonth == "a|b"     # a quoted field may hold the delimiter
    assert df.count() == 4                         # the duplicate line is still there before dedupe
    t = C.to_numeric(C.to_boolean(C.to_timestamp(df, ["TransactionMonth"]), ["IsVATRegistered"]), ["TotalPremium"])
    r1 = t.where("PolicyID = '1'").first()
    assert r1.IsVATRegistered is True and r1.TotalPremium == 21.9 and str(r1.TransactionMonth) == "2015-03-01 00:00:00"
    assert t.where("PolicyID = '4'").first().TotalPremium == 0.0
    assert C.dedupe(t).count() == 3


def test_write_table_fixes_extension(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    out = IO.write_table(df, str(tmp_path / "t.txt"), fmt="parquet")
    assert out.endswith(".parquet") and spark.read.parquet(out).count() == 1
