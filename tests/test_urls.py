from urllib.parse import urljoin

from pyspark.sql import functions as F

from pairmine.functions import urls

REFERENCES = [
    "g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", "g;x", "g;x?y#s", "",
    ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g", "/../g", "g.",
    ".g", "..g", "./../g", "./g/.", "g/./h", "g/../h", "a//b", "//h/p/../q", "HTTP://X/y",
    " lead.png", "my photo.jpg", "mailto:x", "a%20b?c=d&e=f", "/a//b/../c",
]
BASES = ["http://a/b/c/d;p?q", "https://ex.com", "https://ex.com?x=1", "http://a/b//c/d", "https://ex.com/a/"]


def test_resolution_agrees_with_the_standard_library(spark):
    cases = [(b, r, urljoin(b, r)) for b in BASES for r in REFERENCES]
    df = spark.createDataFrame(cases, "page string, src string, expected string")
    got = df.select("*", urls.resolve_url("page", "src").alias("got")).filter(
        ~F.col("got").eqNullSafe(F.col("expected"))
    )
    assert got.collect() == []


def test_fetchable(spark):
    cases = {"http://a/b": True, "https://a": True, "HTTP://a": False, "ftp://a": False, "": False, None: False}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    out = df.select("u", urls.is_fetchable(F.col("u")).alias("ok")).collect()
    assert {r.u: r.ok for r in out} == cases


def test_asset_names(spark):
    cases = {
        "http://e.com/p/my photo(1).png?x=1": "my_photo_1_.png",
        "http://e.com/p/pic": "pic.jpg",
        "http://e.com/é_1.gif#f": "é_1.gif",
    }
    fallback = ["http://e.com/", "http://e.com/.hidden"]
    df = spark.createDataFrame([(u,) for u in [*cases, *fallback]], "u string")
    names = {r.u: r.name for r in df.select("u", urls.asset_name("u").alias("name")).collect()}
    for url, name in cases.items():
        assert names[url].split("_", 1)[1] == name
    for url in fallback:
        assert names[url].split("_", 1)[1].startswith("image_") and names[url].endswith(".jpg")
    assert len(set(names.values())) == len(names)
