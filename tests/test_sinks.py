import tempfile

from ioclake.sources.sinks import write_parquet_counted
from ioclake.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_counted_write_reports_rows(spark):
    out = tempfile.mkdtemp(prefix="ioclake-sink-")
    pages = read_table(spark, SF, "pages").select("page_id", "url")
    n = write_parquet_counted(pages, out + "/t", "pages", mode="overwrite")
    assert n == pages.count() == spark.read.parquet(out + "/t").count()
