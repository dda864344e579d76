from pyspark.sql import functions as F

from oreflow.functions.links import extract_links, file_name, first_links, index_directory, is_data_file

INDEX = "https://data.example.net/archive/weather/stations/"
HOME = "/archive/weather/stations/"

LISTING = """
<table><tr><td><a href="/archive/weather/">Up</a></td><td><A HREF="?sort=size">Size</A></td></tr>
<tr><td><a href='alpha.csv'>alpha</a></td><td><a href="readings.2020.tsv">2020</a></td></tr>
<tr><td><a href=/archive/weather/stations/beta.csv>beta</a></td><td><a href=alpha.csv>alpha once more</a></td></tr>
</table>
"""


def judged(spark, cases, index=INDEX):
    df = spark.createDataFrame([(h,) for h in cases], "href STRING")
    return {r.href: r.ok for r in df.select("href", is_data_file(F.col("href"), F.lit(index)).alias("ok")).collect()}


def test_each_kind_of_link(spark):
    kinds = {
        "alpha.csv": True, HOME + "alpha.csv": True, "http://mirror.example.net/x.csv": True,  # name, own path, other host
        "": False, None: False, "..": False, "../": False,  # nothing, up
        "?sort=name": False, "?sort=date&desc": False, "#notes": False, "mailto:desk@example.net": False,
        "yearly/": False, HOME: False, "/archive/": False,  # directories
        "/alpha.csv": False, HOME + "yearly/a.csv": False, "/archive/weather/ships/a.csv": False,  # files elsewhere
    }
    assert judged(spark, kinds) == kinds


def test_index_without_slash_query_or_path(spark):
    urls = [INDEX, INDEX[:-1], INDEX + "?x=1", "https://a.example.org", "https://a.example.org//", "not a url"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i INT, u STRING")
    got = [r[0] for r in df.orderBy("i").select(index_directory(F.col("u"))).collect()]
    assert got == [HOME] * 3 + ["/"] * 3


def test_extraction_keeps_order_and_strips_quotes(spark):
    pages = spark.createDataFrame([(7, INDEX, LISTING), (8, INDEX, "plain text"), (9, INDEX, None)], "page_id INT, url STRING, html STRING")
    links = extract_links(pages)
    assert [(r.page_id, r.href) for r in links.orderBy("page_id", "pos").collect()] == [
        (7, h) for h in ("/archive/weather/", "?sort=size", "alpha.csv", "readings.2020.tsv", HOME + "beta.csv", "alpha.csv")
    ]
    files = first_links(links.filter(is_data_file(F.col("href"), F.col("url"))))
    assert {(r.name, r.first_pos) for r in files.collect()} == {("alpha.csv", 2), ("readings.2020.tsv", 3), ("beta.csv", 4)}


def test_file_name_of_relative_target_is_kept(spark):
    df = spark.createDataFrame([("a/b",), ("/a/b",)], "h STRING")
    assert [r[0] for r in df.select(file_name(F.col("h"))).collect()] == ["a/b", "b"]
