from conftest import rows

from ioclake.operators import iocs as io


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc long, text string")


def types_of(spark, text):
    d = docs(spark, [text])
    return (sorted(rows(io.pattern_iocs(d, "doc"), "type", "value"))
            + sorted(rows(io.url_email_iocs(d, "doc"), "type", "value")))


def test_ip_inside_url_counts_twice(spark):
    assert types_of(spark, "see http://10.0.0.1/x now") == [
        ("IP_ADDRESS", "http://10.0.0.1/x"), ("URL", "http://10.0.0.1/x")]


def test_octets_unchecked(spark):
    assert types_of(spark, "999.999.999.999") == [("IP_ADDRESS", "999.999.999.999")]


def test_cve_case_sensitive(spark):
    assert types_of(spark, "CVE-2021-44228 cve-2021-44228") == [("CVE", "CVE-2021-44228")]


def test_hash_lengths(spark):
    h = "a" * 32, "b" * 33, "c" * 40, "d" * 64
    got = types_of(spark, " ".join(h))
    assert got == [("MD5_HASH", h[0]), ("SHA1_HASH", h[2]), ("SHA256_HASH", h[3])]


def test_accent_boundary(spark):
    assert types_of(spark, "é" + "a" * 32) == []


def test_email_and_url_rules(spark):
    got = types_of(spark, "mail bob@ex.com www.x.io host.example.com word.notatld a.b.")
    assert got == [("Email", "bob@ex.com"), ("URL", "host.example.com"), ("URL", "www.x.io")]


def test_ioc_union_order(spark):
    m = spark.createDataFrame([(0, 0, 2, "Paris", "GPE")], "doc long, sent long, pos long, text string, label string")
    d = docs(spark, ["1.2.3.4 bob@ex.com"])
    u = io.all_iocs(io.mention_iocs(m), io.token_iocs(d, "doc"))
    got = sorted(rows(u, "src_rank", "type", "value"))
    assert got == [(0, "GPE", "Paris"), (1, "IP_ADDRESS", "1.2.3.4"), (2, "Email", "bob@ex.com")]
