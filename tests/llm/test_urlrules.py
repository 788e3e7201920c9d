import random
import re

import pytest

from pairmine.llm import urlrules

from .helpers import with_clashes


def brute(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if c.isascii() else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [
        (len(h + p), h + p, v) for v, h, p in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://", "http://Example.COM/en/x?y#z", "http://www.example.com/en/", "https://a.b.net/fr",
    "https://a.b.net/fr/1", "http://net/es/", "http://xnet/es/", "http://com", "http://com/", "x://y://z/en/", "http://example.com.net/es/?a=/b",
    "http://a..com/", "http://.com/", "HTTP://M.example.com/en/#a?b", "http://example-x.com/en/", "http://com.example/",
]


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_brute_force(spark, parts):
    chosen = random.Random(parts)
    labels = ["com", "net", "a", "b", "ab", "a-b"]
    rules = [(chosen.choice(["allow", "block"]), ".".join(chosen.choices(labels, k=chosen.randint(1, 3))), chosen.choice(["/", "/a", "/a/b", ""])) for _ in range(25)]
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values()) + [("block", "", "/")]
    urls = URLS + [f"http://{'.'.join(chosen.choices(labels, k=chosen.randint(1, 4)))}{chosen.choice(['', '/', '/a', '/a/b/c', '/b'])}" for _ in range(300)]
    urls += ["http://hot.a.com/a"] * 50
    pages = spark.createDataFrame([(i if i % 9 else None, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = urlrules.judge(with_clashes(pages.repartition(parts), "host", "rule", "key", "part"), urlrules.rule_table(spark, rules))
    mine = sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()], key=str)
    assert mine == sorted([(i if i % 9 else None, *brute(u, rules)) for i, u in enumerate(urls)], key=str)


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = urlrules.rule_table(spark, urlrules.RULES).limit(0)
    assert urlrules.judge(pages, none).first().verdict == "allow"
    assert urlrules.judge(pages.limit(0), urlrules.rule_table(spark, urlrules.RULES)).count() == 0
