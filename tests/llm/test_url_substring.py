"""URL rules and substring deduplication on edge cases, against direct Python."""

import hashlib
import itertools
import random
import re
import time

from designlab.llm import stored, substring, url_rules

URLS = [None, "", "no scheme", "http://Example.COM/en/1?x", "https://www.example.com/en/", "http://a.net/es/x#y",
        "http://net/fr", "x://com", "http://notcom/", "http://b.example.com/en", "http://É.net/fr/É?q", "://com/a",
        "http://a.org/en/://com/", "http://com?x=/en/", "http://xexample.com/en/"]


def direct_rule(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = (None, None)
    for kind, text in url_rules.RULES:
        suffix, _, prefix = text.partition("/")
        if (host == suffix or host.endswith("." + suffix)) and path.startswith("/" + prefix) \
                and len(text) > len(best[0] or ""):
            best = (text, kind)
    return host, path, *best


def test_rule_list(spark):
    rows = [(i, u, "x", 1) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.filter_urls(pages).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = direct_rule(u)
        assert got[i][:3] == (host, path, rule), u
        assert got[i][3] == (verdict or "allow"), u
    assert url_rules.filter_urls(pages.limit(0)).count() == 0


def test_mined_rules_judge_unlisted_pages(spark):
    rows = [(i, f"http://spam{i % 7}.example.net/es/casino/{i}") for i in range(40)]
    rows += [(100 + i, f"http://good{i}.com/news/{i}") for i in range(40)]
    rows += [(500, "http://x.org/casino/5"), (501, "http://x.org/news/5")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_rules.filter_urls(pages).collect()}
    assert got[500] == "block" and got[501] == "allow"
    labelled = url_rules.judged(pages).where("listed is not null").select("tokens", "listed")
    mined = url_rules.mine(labelled)
    rows = url_rules.judged(pages).select("tokens", url_rules.matches(url_rules.F.col("tokens"), mined).alias("m"))
    for r in rows.collect():
        assert r["m"] == any(set(t) <= set(r["tokens"]) for t, _, _ in mined)


def direct_rules(rows, least, needed):
    """Minimal token sets on at least ``least`` blocked pages with confidence ``needed``."""
    found = {}
    tokens = sorted({t for ts, _ in rows for t in ts})
    for n in range(1, len(tokens) + 1):
        for c in itertools.combinations(tokens, n):
            if not any(set(k) < set(c) for k in found):
                on = [kind for ts, kind in rows if set(c) <= set(ts)]
                if on.count("block") >= least and on.count("block") / len(on) >= needed:
                    found[c] = (on.count("block") / len(on), on.count("block") / len(rows))
    return found


def test_mined_rules_match_every_token_set(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(1500):
        ts = [t for t in "abcdefg" if rng.random() < 0.45]
        bad = {"a", "b"} <= set(ts) or {"c", "d", "e"} <= set(ts) or "g" in ts
        rows.append((ts, "block" if bad and rng.random() < 0.97 else "allow"))
    share = sum(k == "block" for _, k in rows) / len(rows)
    got = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, listed string"), min_lift=1.1)
    want = direct_rules(rows, url_rules.MIN_PAGES, max(0.9, 1.1 * share))
    assert len(want) > 2 and ("g",) in want and ("a", "b") in want
    assert {t: (round(c, 9), round(s, 9)) for t, c, s in got} == {
        t: (round(c, 9), round(s, 9)) for t, (c, s) in want.items()}
    skipped = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, listed string"), skip=["g"])
    assert all("g" not in t for t, _, _ in skipped)


def test_long_repeated_url_is_mined_in_bounded_time(spark):
    long = [f"p:t{k}" for k in range(40)]
    rows = [([*long], "block" if k % 2 else "allow") for k in range(1000)]
    rows += [(long[:k % 40] + ["p:bad"], "block") for k in range(400)] + [(["p:good"], "allow")] * 400
    rows += [([], "allow"), (["p:bad", "p:bad2"], "block")]
    mined = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, listed string"))
    assert (("p:bad",), 1.0) in [(t, c) for t, c, _ in mined]
    assert url_rules.mine(spark.createDataFrame([], "tokens array<string>, listed string")) == []


def test_rules_of_wide_pages_are_whole(spark):
    rng = random.Random(11)
    tokens = [f"p:{c}" for c in "abcdefghijkl"]
    rows = []
    for _ in range(600):
        ts = [t for k, t in enumerate(tokens) if rng.random() < (0.85 if k < 8 else 0.4)]
        bad = {"p:i", "p:j"} <= set(ts) or {"p:k", "p:l"} <= set(ts) or ("p:a" not in ts and rng.random() < 0.4)
        rows.append((ts, "block" if bad and rng.random() < 0.97 else "allow"))
    assert max(len(ts) for ts, _ in rows) > 10
    df = spark.createDataFrame(rows, "tokens array<string>, listed string")
    share = sum(k == "block" for _, k in rows) / len(rows)
    want = direct_rules(rows, url_rules.MIN_PAGES, max(0.9, 1.2 * share))
    assert ("p:i", "p:j") in want and ("p:k", "p:l") in want
    for basket in (10, 2):
        got = {t: (round(c, 9), round(s, 9)) for t, c, s in url_rules.mine(df, basket=basket)}
        assert got == {t: (round(c, 9), round(s, 9)) for t, (c, s) in want.items()}, basket


def direct_substring(rows):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    big = 1 << 63
    lowest = {}
    for i, w in docs:
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            lowest[g] = min(lowest.get(g, big), big - 1 if i is None else i)
    out = []
    for i, w in docs:
        gone = {p for k in range(len(w) - 12) if lowest[tuple(w[k:k + 13])] < (big - 1 if i is None else i)
                for p in range(k, k + 13)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_edges(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"{i}w{j}" for j in range(i * 3)) + " " + passage + f" end{i}") for i in range(1, 25)]
    rows += [(30, None), (31, ""), (32, " \n"), (33, "a " * 40), (34, "a " * 13), (35, "a " * 12), (None, passage),
             (None, passage), (36, passage), (36, passage), (37, passage[:-4]), (38, "é\u3000 " * 50),
             (0, "long " + " ".join(f"x{j % 977}" for j in range(200_000)))]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, _words int, lang string")
    got = sorted((tuple(r) for r in substring.report(docs).collect()), key=str)
    assert got == direct_substring(rows)
    assert substring.report(docs.limit(0)).count() == 0
    out = substring.remove(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept[1] == rows[0][1] and kept[2].endswith("2w5 end2") and kept[30] is None


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return [n for f in files.mkString("\n").split("\n") if (n := f.rsplit("/", 1)[-1]).startswith("shuffle_")]


def test_substring_steps_leave_no_rows_per_window(spark, monkeypatch):
    passage = " ".join(f"q{i}" for i in range(400))
    docs = spark.createDataFrame([(i, passage + f" {i}") for i in range(20)], "doc_id long, text string")
    sizes = []

    def counted(df):
        had = set(shuffle_files(spark))
        out = stored.stored(df)
        end = time.time() + 20
        while set(shuffle_files(spark)) - had and time.time() < end:
            time.sleep(0.2)
        assert not set(shuffle_files(spark)) - had
        sizes.append(out.count())
        return out

    monkeypatch.setattr(substring, "stored", counted)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    got = substring.report(docs)
    assert spark.conf.get(key, None) == was
    assert max(sizes) <= docs.count()
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == {i: 400 * (i > 0) for i in range(20)}


def test_hot_anchors_and_windows_are_dealt_out(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(150), "a " * 40) for _ in range(200)]
    rows += [(rng.randrange(300), " ".join(rng.choice("ab") for _ in range(60))) for _ in range(100)]
    rows += [(None, "a " * 30), (None, "b " * 13)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    keyed = substring._keyed(docs)
    marks = substring.anchors(keyed)
    found = substring.windows(keyed.withColumn("at", substring.F.expr("if(text like '% a a a a a a %', array(0), array())")))
    assert marks.count() > 3000 and found.count() > 200
    assert max(r["count"] for r in marks.groupBy("key").count().collect()) < 400
    assert max(r["count"] for r in found.groupBy("a", "b").count().collect()) < 100
    assert sorted((tuple(r) for r in substring.report(docs).collect()), key=str) == direct_substring(rows)
