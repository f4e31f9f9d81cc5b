"""Property check: reference resolution equals Python's urljoin on
random relative references (dot segments, empty segments, queries,
fragments) against random bases, evaluated in one Spark pass."""

import random
import urllib.parse

from pyspark.sql import functions as F

from lodestar.functions import url as U

SEGMENTS = ["a", "b", "..", ".", "", "c.html", "d"]


def _random_path(rnd, absolute):
    segs = [rnd.choice(SEGMENTS) for _ in range(rnd.randint(0, 5))]
    p = "/".join(segs)
    return ("/" + p) if absolute else p


def _random_ref(rnd):
    kind = rnd.random()
    if kind < 0.1:
        ref = "//host.example.com" + _random_path(rnd, True)
    elif kind < 0.5:
        ref = _random_path(rnd, True)
    else:
        ref = _random_path(rnd, False)
    if rnd.random() < 0.2:
        ref += "?q=" + rnd.choice(["1", "x", ""])
    if rnd.random() < 0.2:
        ref += "#frag"
    return ref


def test_resolution_matches_urljoin(spark):
    rnd = random.Random(11)
    bases = ["http://a.example.com" + _random_path(rnd, True) + rnd.choice(["", "?b=1"]) for _ in range(40)]
    bases += ["https://x.example.org", "http://y.example.net/"]
    rows = [(rnd.choice(bases), _random_ref(rnd)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "b string, r string")
    got = df.select("b", "r", U.url_join(F.col("b"), U.remove_fragment(F.col("r"))).alias("x")).collect()
    bad = [(g.b, g.r, g.x) for g in got if g.x != urllib.parse.urljoin(g.b, urllib.parse.urldefrag(g.r)[0])]
    assert not bad, bad[:5]
