"""Exact groups, URL rules and site lines against plain Python, and that no Python runs in them."""

import random
import re
from collections import Counter

from brute import DOCS, documents
from pyspark.sql import functions as F

from stagetrail.llm import lines, urls
from stagetrail.llm.exact import exact_groups


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_groups(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "A", "a ", "x" * 70, "x" * 69 + "y", "x" * 64 + "zzzzzz", "é", "e\u0301", "long " * 30000] * 3
    texts += [rng.choice(["dup one", "dup two", f"alone {i}"]) for i in range(200)] + ["dup one"] * 400
    docs = documents(spark, texts, extra=True)
    members = {}
    for i, t in enumerate(texts):
        members.setdefault(t or "", []).append(i)
    want = {i: (max(m), len(m), i == max(m)) for m in members.values() for i in m}
    found = exact_groups(docs)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()} == want
    assert not re.search("Python|Pandas|Arrow", plan_of(found))


def test_exact_groups_of_odd_rows(spark):
    assert exact_groups(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "t", None, None, None), (4, "t", None, None, None), (4, "t", None, None, None), (4, "other", None, None, None), (None, None, None, None, None)]
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(spark.createDataFrame(rows, DOCS)).collect())
    assert got == Counter({(4, 4, 3, True): 2, (None, 4, 3, False): 1, (4, 4, 1, True): 1, (None, None, 1, True): 1})


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("Www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("q.org", "", "block"), (None, "/", "block"), ("x", None, "allow")]
URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://Example.COM/en/1", "http://example.com/en", "http://www.example.com/en/x?q=/fr/", "http://a.www.example.com/en/",
    "http://badexample.com/en/", "http://com/", "http://com", "http://x.net/es/1#f", "http://x.net/fr/", "http://xnet/fr/", "http://x.net?a=/fr/", "http://x.net/ES/",
    "http://a.q.org", "http://q.org:80/", "http://u@q.org/", "ftp://q.org#x", "http://ÀÉ.com/", "http://e.com//", "x://y://z.net/fr/", "http://.com/", "http://a..com/x\ny",
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match("[^/?#]*", rest)[0])
    path = re.match("[^?#]*", rest[len(host) :])[0]
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in ((h.lower(), p, v) for h, p, v in rules if h is not None and p is not None)
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_against_plain_python(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS)] + [(None, URLS[5])], "page_id long, url string")
    pages = pages.withColumns({c: F.lit("clash") for c in ("host", "path", "key", "rule", "verdict", "block", "h", "p")})
    found = urls.judge_urls(pages, rules)
    got = found.collect()
    assert len(got) == 2 * len(URLS) + 1
    for r in got:
        url = URLS[5] if r["page_id"] is None else (URLS + URLS)[r["page_id"]]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged(url, RULES), url
    assert not re.search("Python|Pandas|Arrow", plan_of(found))
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in urls.judge_urls(pages, none, otherwise="keep").collect()} == {"keep"}
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_many_rules(spark):
    rng = random.Random(2)
    hosts = [f"h{i}.site{i % 9}.org" for i in range(300)] + [f"site{i}.org" for i in range(9)]
    rules = [(h, rng.choice(["", "/", "/a/", "/a/b", "/long/path/"]), rng.choice(["allow", "block"])) for h in hosts]
    pages = [f"https://{rng.choice(['www.', '', 'x.y.'])}{rng.choice(hosts)}{rng.choice(['', '/', '/a/', '/a/bc', '/long/path/z', '/other'])}" for _ in range(600)]
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = urls.judge_urls(frame, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert all((r["host"], r["path"], r["rule"], r["verdict"]) == judged(pages[r["page_id"]], rules) for r in got) and len(got) == 600


def test_the_filter_passes_every_listed_key_and_few_others(spark):
    keys = spark.range(5000).select(F.concat(F.lit("listed/"), "id").alias("key"))
    others = spark.range(50_000).select(F.concat(F.lit("other/"), "id").alias("key"))
    blocks = 5000 * urls.BITS_PER_KEY // (64 * urls.WORDS)
    built = urls.bloom_blocks(keys, blocks)
    assert built.count() <= blocks
    assert urls.possible(keys, built, blocks).count() == 5000
    assert urls.possible(others, built, blocks).count() < 500


def page(*body):
    return "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><!-- <p>no</p> -->" + "".join(body) + "</body></html>"


def test_site_lines(spark):
    rows = []
    for i in range(40):
        body = ["<nav><li>Home</li><LI>About</li></nav>"] + [f"<p>Own <b>text</b> {i}</p>"] + (["<p>Now and then</p>"] if i < 4 else []) + ["Tail<br>Footer "]
        rows.append((i, "https://Big.org/x", page(*body)))
    rows += [(100 + i, f"https://small.org/{i}", page("<p>Home</p>")) for i in range(5)]
    rows += [(200, None, page("<p>Home</p>")), (201, "https://big.org", None), (202, "https://big.org", ""), (None, "https://big.org", page("Home")), (1, "https://big.org", page("Home"))]
    rows.append((300, "https://big.org", page("<p>" + "word " * 50_000 + "</p>")))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "lines", "line", "total", "n")})
    found = lines.drop_site_lines(pages, ratio=0.2)
    got = {}
    for r in found.collect():
        got.setdefault(r["page_id"], []).append((r["host"], r["lines"], r["dropped"], r["text"]))
    assert sum(map(len, got.values())) == len(rows)
    assert got[0] == [("big.org", 7, 5, "Own text 0\nNow and then")]
    assert got[20] == [("big.org", 6, 5, "Own text 20")]
    assert got[100] == [("small.org", 2, 2, "")] and got[200] == [("", 2, 0, "T\nHome")]
    assert got[201] == got[202] == [("big.org", 0, 0, "")] and got[None] == [("big.org", 2, 2, "")]
    assert got[300][0][:3] == ("big.org", 2, 1)
    assert not re.search("Python|Pandas|Arrow", plan_of(found))
    assert lines.drop_site_lines(pages.limit(0)).count() == 0


def test_site_lines_on_hosts_of_any_size(spark):
    """No jump: a line on every page goes from two pages on, one on a twentieth of the pages never does."""
    rows = []
    for size in (1, 2, 3, 9, 10, 11, 1000):
        for i in range(size):
            own = ["Rare"] if i < max(1, size // 20) else []
            rows.append((len(rows), f"https://h{size}.org/{i}", "<br>".join(["Menu", f"Own {i}", *own])))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for r in lines.drop_site_lines(pages).collect():
        got.setdefault(int(r["host"][1:-4]), []).append((r["dropped"], "Menu" in r["text"], "Rare" in r["text"]))
    assert got[1] == [(0, True, True)]
    for size in (2, 3, 9, 10, 11, 1000):
        assert len(got[size]) == size and all(d == 1 and not menu for d, menu, _ in got[size])
        assert sum(rare for _, _, rare in got[size]) == max(1, size // 20)


def test_urls_of_hosts_with_many_labels(spark):
    """The work follows the rules' labels, not the square of the host's."""
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.b.net", "/x/", "block")], "host string, path string, verdict string")
    host = "a." * 20_000
    rows = [(1, f"https://{host}com/y"), (2, f"https://{host}b.net/x/z"), (3, f"https://{host}b.net/y"), (4, "https://b.net/x/"), (5, "https://" + "." * 5000 + "com/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got == {1: ("com/", "allow"), 2: ("a.b.net/x/", "block"), 3: (None, "allow"), 4: (None, "allow"), 5: ("com/", "allow")}
