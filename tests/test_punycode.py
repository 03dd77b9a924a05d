"""Hosts in ASCII against the standard library's codec."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows

from ioclake.functions.punycode import ascii_host_sql
from ioclake.functions.urls import with_normalized_url


def hosts(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, h string")
    return [r[1] for r in sorted(rows(df.select("i", F.expr(ascii_host_sql("h")).alias("a"))))]


def codec(host):
    out = []
    for label in host.split("."):
        done = label if label.isascii() else "xn--" + label.encode("punycode").decode()
        if len(label) > 63 or len(done) > 63:
            return None
        out.append(done)
    return ".".join(out)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=33, exclude_categories=["Cs"], exclude_characters="\u3002\uff0e\uff61")
                        | st.sampled_from("abz-.üß日本"), max_size=70), min_size=1, max_size=12))
def test_equal_to_the_codec(spark, values):
    assert hosts(spark, values) == [codec(v) for v in values]


def test_known_names(spark):
    assert hosts(spark, ["bücher.example", "münchen.de", "日本語.jp", "ex。ample｡org", "plain.org", "", None]) == [
        "xn--bcher-kva.example", "xn--mnchen-3ya.de", "xn--wgv71a119e.jp", "ex.ample.org", "plain.org", "", None]
    assert hosts(spark, ["ü" * 64, "a" * 64 + ".ü", "🙂" * 63]) == [None, None, codec("🙂" * 63)]


def test_urls(spark):
    urls = ["https://BÜCHER.example:443/ü?q#f", "http://user@日本.jp:8080/", "http://" + "ü" * 64 + ".de/", "http://[::1]:99/x"]
    df = spark.createDataFrame(list(enumerate(urls)), "i int, u string")
    got = [tuple(r)[1:] for r in sorted(rows(with_normalized_url(df, "u"), "i", "url_norm", "url_reject"))]
    assert got == [("https://xn--bcher-kva.example/%C3%BC?q#f", None), ("http://user@xn--wgv71a.jp:8080/", None), (None, "host"),
                   ("http://[::1]:99/x", None)]
