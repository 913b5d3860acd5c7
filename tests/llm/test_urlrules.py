from itertools import combinations

from pyspark.sql import functions as F

from insight.llm import urlrules
from insight.llm.urlrules import HOST_RULES, judge_urls, mine_rules, page_labels, url_tokens

URLS = ["http://A.Example.org/es/1", "https://example.org/en/12?x=1", "https://www.fr.com/fr/a#top", "http://x.com/de/",
        "ftp://org", "no scheme", None, "", "http://notorg/x", "https://org/", "https://a.org?q=http://com/de/",
        "http://u@b.net:80/p/9.html", "x://y://z/w", "https://sub.example.org/en/2", "http://", "https://a.com/de", "h\nt://b.com/de/\n1"]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def plain_rule(host, path):
    fits = [(len(h) + len(p), h + p, v) for v, h, p in HOST_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def pages_frame(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", 0.1, "t") for i, u in enumerate(urls)],
                                 "page_id bigint, url string, html string, confidence double, tokens string")


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_host_path_and_host_rules(spark):
    pages = pages_frame(spark, URLS)
    got = judge_urls(pages, labels_frame(spark, [])).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = plain(URLS[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
    tokens = pages.select("url", url_tokens(F.col("url")).alias("t")).collect()
    assert all((r["t"] == []) == (r["url"] is None or "://" not in r["url"]) for r in tokens)


def training(spark):
    urls, labels = [], []
    for i in range(400):
        spam = i % 4 == 0
        urls.append(f"https://{'bad' if spam else 'good'}{i % 2}.net/{'win' if i % 5 == 0 else 'en'}/{i}.html{'?ref=x' if i % 3 else ''}")
        labels.append((i, 0 if spam and i % 16 else 1, 0))
    return pages_frame(spark, urls), labels_frame(spark, labels + [(None, 0, 1), (3, 1, 0), (9999, 0, 0)])


def plain_rules(rows, support, confidence):
    """All token combinations counted one by one."""
    counts, bad = {}, {}
    for tokens, label in rows:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                counts[c] = counts.get(c, 0) + 1
                bad[c] = bad.get(c, 0) + label
    least = support * len(rows)
    rules = {frozenset(c): bad[c] / n for c, n in counts.items() if bad[c] >= least and bad[c] / n >= confidence}
    return {b: c for b, c in rules.items() if not any(rules.get(b - {x}, 0) >= c for x in b if len(b) > 1)}


def test_rules_equal_counting_all_combinations(spark):
    pages, labels = training(spark)
    labelled = page_labels(pages, labels)
    rows = [(r["tokens"], r["bad"]) for r in labelled.collect()]
    assert len(rows) == 400
    got = {frozenset(r["tokens"]): r["confidence"] for r in mine_rules(labelled, 0.05, 5, 0.6)}
    assert got and got == plain_rules(rows, 0.05, 0.6)


def test_all_tokens_of_long_urls_are_mined(spark):
    """16 frequent tokens a URL; the telling pair is among the rarest."""
    rows = []
    for i in range(240):
        tokens = [f"p{k}:x" for k in range(9)]
        tokens += [f"q:{name}={'a' if i % step else 'b'}" for name, step in (("u", 5), ("v", 7))]
        tokens += [f"q:w={i % 3}", f"h1:{'y' if i % 16 else 'z'}", f"x:{i % 4}", f"s:{i % 2}"]
        spam = i % 3 == 1 and i % 4 == 2
        rows.append((tokens + [f"f:{i % 5 == 1}"], int(spam and i % 7 > 0 or i % 16 == 0)))
    assert all(len(set(t)) == 16 for t, _ in rows)
    labelled = spark.createDataFrame(rows, "tokens array<string>, bad int")
    got = {frozenset(r["tokens"]): r["confidence"] for r in mine_rules(labelled, 0.02, 5, 0.6)}
    assert frozenset(["q:w=1", "x:2"]) in got
    assert got == plain_rules(rows, 0.02, 0.6)


def test_tokens_that_always_come_together_cost_one(spark):
    rows = [([f"t{k}" for k in range(40)] + [f"r:{i % 4}"], int(i % 4 == 0)) for i in range(80)]
    labelled = spark.createDataFrame(rows, "tokens array<string>, bad int")
    assert [(r["tokens"], r["count"], r["confidence"]) for r in mine_rules(labelled, 0.1, 5, 0.6)] == [(["r:0"], 20, 1.0)]


def test_verdicts_follow_the_rules(spark):
    pages, labels = training(spark)
    rules = plain_rules([(r["tokens"], r["bad"]) for r in page_labels(pages, labels).collect()], 0.05, 0.6)
    out = judge_urls(pages, labels, min_support=0.05, min_count=5, min_confidence=0.6)
    tokens = {r["page_id"]: set(r["t"]) for r in pages.select("page_id", url_tokens(F.col("url")).alias("t")).collect()}
    seen = set()
    for r in out.collect():
        want = max((c for body, c in rules.items() if body <= tokens[r["page_id"]]), default=0.0)
        assert r["confidence"] == want
        assert r["verdict"] == ("block" if want else "allow")
        seen.add(r["verdict"])
    assert seen == {"allow", "block"}


def test_empty_tables_and_repeats(spark):
    assert judge_urls(pages_frame(spark, []), labels_frame(spark, [])).count() == 0
    pages, labels = training(spark)
    twice = judge_urls(pages.union(pages), labels).collect()
    assert len(twice) == 800
    assert urlrules.mine_rules(page_labels(pages, labels), min_support=2.0) == []
