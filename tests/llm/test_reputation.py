import math

from citylens.llm import reputation as R


def test_rules_and_hosts(spark):
    rows = [(1, "http://A.example.ORG/es/x?y"), (2, "https://example.org/en/19"), (3, "https://example.org/en/2"), (4, "https://notexample.org/es/"),
            (5, "http://x.com/de/a#b"), (6, "http://x.com/fr/a"), (7, "http://x.net/"), (8, None), (9, "no scheme"), (10, "http://x.org"),
            (11, "ftp://u.com?q=://z.org/"), (11, "ftp://u.com?q=://z.org/"), (12, "a://b\nc/d\ne?f"), (None, "http://com/fr/")]
    pages = spark.createDataFrame([(a, b, "x") for a, b in rows], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in R.judge(pages, none).collect()}
    assert got == {
        (1, "a.example.org", "/es/x"): ("example.org/es/", "block"), (2, "example.org", "/en/19"): ("example.org/en/1", "block"),
        (3, "example.org", "/en/2"): ("org/", "allow"), (4, "notexample.org", "/es/"): ("org/", "allow"),
        (5, "x.com", "/de/a"): ("com/de/", "block"), (6, "x.com", "/fr/a"): ("com/fr/", "allow"), (7, "x.net", "/"): (None, "allow"),
        (8, "", ""): (None, "allow"), (9, "", ""): (None, "allow"), (10, "x.org", ""): (None, "allow"), (11, "u.com", ""): (None, "allow"),
        (12, "b\nc", "/d\ne"): (None, "allow"), (None, "com", "/fr/"): ("com/fr/", "allow")}
    assert R.judge(pages, none).count() == len(rows)
    assert R.judge(pages.limit(0), none).count() == 0


def test_domains(spark):
    hosts = {"a.b.co.uk": "b.co.uk", "co.uk": "co.uk", "b.co.uk": "b.co.uk", "x.y.example.com": "example.com", "localhost": "localhost", "10.0.0.1": "10.0.0.1", "": ""}
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(h,) for h in hosts], "host string").withColumn("suffix", R.suffix_of(F.col("host")))
    assert {r["host"]: r["d"] for r in df.withColumn("d", R.domain_of(F.col("host"), F.col("suffix"))).collect()} == hosts


def model(counts):
    """Posterior mean and deviation per host, step by step; counts: {(suffix, domain, host): (n, k)}."""
    def strength(units):
        top = sum((k - n * p) ** 2 for n, k, p in units) - sum(n * p * (1 - p) for n, k, p in units)
        low = sum(n * (n - 1) * p * (1 - p) for n, k, p in units)
        return 1 / max(0.001, min(0.99, top / low if low else 0.5)) - 1

    def total(depth):
        out = {}
        for key, (n, k) in counts.items():
            a, b = out.get(key[:depth], (0, 0))
            out[key[:depth]] = (a + n, b + k)
        return out

    mean = {(): (total(0)[()][1] + 0.5) / (total(0)[()][0] + 1)}
    raw = dict(mean)
    for depth in (1, 2, 3):
        level = total(depth)
        a = strength([(n, k, raw[key[:-1]]) for key, (n, k) in level.items()])
        up = dict(mean)
        for key, (n, k) in level.items():
            m = up[key[:-1]]
            if depth == 3:
                x, y = k + a * m, n - k + a * (1 - m)
                mean[key] = (x / (x + y), math.sqrt(x * y / ((x + y) ** 2 * (x + y + 1))))
            else:
                mean[key], raw[key] = (k + a * m) / (n + a), (k + 0.5) / (n + 1)
    return {key[2]: v for key, v in mean.items() if len(key) == 3}


def test_posteriors_follow_the_chain_and_block_bad_hosts(spark):
    counts = {("com", "spam.com", f"h{i}.spam.com"): (30, 28) for i in range(5)}
    counts |= {("com", "good.com", f"h{i}.good.com"): (40, 1) for i in range(5)} | {("net", "mix.net", "a.mix.net"): (50, 47), ("net", "mix.net", "b.mix.net"): (50, 2)}
    counts |= {("com", "spam.com", "new.spam.com"): (0, 0), ("com", "good.com", "one.good.com"): (1, 1)}
    pages, outcomes, i = [], [], 0
    for (_, _, host), (n, k) in counts.items():
        for j in range(n):
            pages.append((i, f"http://{host}/{j}"))
            outcomes.append((i, int(j < k)))
            i += 1
        if not n:
            pages.append((i, f"http://{host}/"))
            i += 1
    outcomes += [(10**6, 1), (0, None), (0, 0)]         # unknown page, unknown outcome, a better outcome of a bad page
    got = {r["host"]: r for r in R.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), rules=()).collect()}
    want = model(counts)
    for host, (m, sd) in want.items():
        assert math.isclose(got[host]["bad_share"], m, rel_tol=1e-9) and math.isclose(got[host]["bad_bound"], m - R.Z * sd, rel_tol=1e-9, abs_tol=1e-12)
    assert {h for h, r in got.items() if r["verdict"] == "block"} >= {f"h{i}.spam.com" for i in range(5)} | {"a.mix.net"}
    assert all(got[h]["verdict"] == "allow" for h in ("h0.good.com", "one.good.com", "b.mix.net"))
    assert got["new.spam.com"]["bad_share"] > got["one.good.com"]["bad_share"]      # no label against one bad page: the domain decides
