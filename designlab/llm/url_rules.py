"""URL filtering: a suffix rule list first, mined association rules for the rest.

The rule list (host suffix and path prefix, longest wins) judges what it fits, and these verdicts
are the labels from which FP-growth mines token combinations ``{tokens} -> block``.  Tokens of the
list itself are not mined: they would only echo it.  Rules below the confidence, support or lift
threshold go, and so does a rule with a shorter rule inside it, which blocks the same pages.  The
survivors form an inverted index (rarest token -> rules); a page is
blocked if a rule found under one of its tokens has all its tokens in the page's url.  Everything
is DataFrame functions; judging needs no shuffle.

All labelled pages are mined.  Tokens that are a rule by themselves need no combination, and tokens that stand on
the same pages are mined as one (the least of them).  Of what is left a page gives FP-growth its ``BASKET`` tokens
most often blocked, so that it has at most 2^BASKET token sets there.  If some page has more tokens, baskets alone
would miss rules and miscount: FP-growth's rules are counted on whole pages then, and ``completed`` finds all
others level by level.  It grows only sets that are blocked often enough, hold no rule, and stand on fewer pages
than each of their parts; every minimal rule consists of such sets.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and is
allowed; repeated rows are judged one by one; an empty table, or one without labels, gives no
mined rules; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from designlab.llm.stored import drop, stored

# fixed values: the rule list (verdict, host/path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.9
#: a rule's confidence over the share of blocked pages
MIN_LIFT = 1.2
#: tokens of a page that FP-growth combines (``completed`` combines the rest)
BASKET = 10
#: a rule needs this many labelled pages besides its support share
MIN_PAGES = 20
BLOCK = "label=block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def judge_list(host, path, rules=RULES) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        suffix, _, prefix = text.partition("/")
        fits = ((host == suffix) | F.endswith(host, F.lit("." + suffix))) & F.startswith(path, F.lit("/" + prefix))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def url_tokens(host, path) -> F.Column:
    """Distinct tokens: ``h:`` host labels and ``p:`` alphanumeric path words, A-Z lower-cased."""
    def words(text, kind):
        found = F.filter(F.split(F.translate(text, UPPER, LOWER), r"[^0-9a-z\x{80}-\x{10FFFF}-]+"), lambda t: t != "")
        return F.transform(found, lambda t: F.concat(F.lit(kind), t))

    return F.array_distinct(F.concat(words(host, "h:"), words(path, "p:")))


def judged(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, listed, tokens) of every page."""
    host, path = host_path(F.col("url"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = judge_list(F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("listed"),
                       url_tokens(F.col("host"), F.col("path")).alias("tokens"))


def list_tokens(rules=RULES) -> list[str]:
    """Tokens that the rule list itself consists of."""
    found = set()
    for _, text in rules:
        host, _, path = text.partition("/")
        found |= {f"h:{x}" for x in host.split(".") if x} | {f"p:{x}" for x in path.split("/") if x}
    return sorted(found)


def minimal(found) -> list:
    """The rules (tokens, confidence, support) without another rule's tokens inside theirs."""
    kept = {}
    for rule in sorted(found, key=lambda r: (len(r[0]), r[0])):
        inside = (c for n in range(1, len(rule[0])) for c in combinations(rule[0], n))
        if not any(c in kept for c in inside):
            kept[rule[0]] = rule
    return list(kept.values())


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_lift: float = MIN_LIFT, basket: int = BASKET, skip: Sequence[str] = ()) -> list[tuple[tuple[str, ...], float, float]]:
    """(tokens, confidence, support) of the minimal block rules, from (tokens, listed) rows; no rule uses ``skip``."""
    block = F.col("listed") == "block"
    seen = labelled.agg(F.count("*").alias("rows"), F.count_if(block).alias("blocked")).first()
    if not seen["blocked"]:
        return []
    least = max(MIN_PAGES, min_support * seen["rows"])
    needed = max(min_confidence, min_lift * seen["blocked"] / seen["rows"])
    each = (labelled.withColumn("row", F.monotonically_increasing_id())
            .select("row", "listed", "tokens", F.xxhash64("tokens", "listed").alias("h"),
                    F.xxhash64(F.lit(1), "tokens", "listed").alias("g"))
            .select("row", "listed", "h", "g", F.explode("tokens").alias("token")))
    # a token that stands on fewer blocked pages is in no rule
    often = (each.where(~F.col("token").isin(list(skip))).groupBy("token")
             .agg(F.count("*").alias("n"), F.count_if(block).alias("blocked"),
                  *(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("h", "g")))
             .where(F.col("blocked") >= least).withColumn("confidence", F.col("blocked") / F.col("n")))
    found = [((r["token"],), r["confidence"], r["blocked"] / seen["rows"])
             for r in often.where(F.col("confidence") >= needed).collect()]
    # tokens that stand on the same pages have the same sums
    rest = (often.where(F.col("confidence") < needed).groupBy("n", "h", "g")
            .agg(F.min("token").alias("token"), F.first("confidence").alias("confidence")).select("token", "confidence"))
    best = F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("order"), "token")))
    pages = (each.join(rest, "token").groupBy("row", "listed").agg(best.alias("best"))
             .select("row", "listed", F.col("best.token").alias("tokens")))
    items = pages.select(F.concat(F.slice("tokens", 1, basket), F.array(F.concat(F.lit("label="), "listed"))).alias("items"))
    rows, widest = pages.agg(F.count("*"), F.max(F.size("tokens"))).first()
    if rows:
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / rows), minConfidence=min(1.0, needed)).fit(items)
        combined = [(tuple(r["tokens"]), r["confidence"], r["support"] * rows / seen["rows"]) for r in
                    model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BLOCK))
                    .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support").collect()]
        if widest > basket:
            wide = stored(pages)
            combined = [(s, blocked / n, blocked / seen["rows"]) for s, n, blocked in
                        completed(wide, [s for s, _, _ in minimal(combined)], least, needed)]
            drop(wide)
        found += combined
    return minimal(found)


def counted(pages: DataFrame, sets: Sequence[tuple[str, ...]]) -> list[tuple[tuple[str, ...], int, int]]:
    """(tokens, pages, blocked pages) of token sets, from (row, listed, tokens) pages."""
    if not sets:
        return []
    table = pages.sparkSession.createDataFrame([(list(s),) for s in sets], "s array<string>")
    on = (pages.select("row", "listed", F.explode("tokens").alias("token")).join(table.select("s", F.explode("s").alias("token")), "token")
          .groupBy("row", "listed", "s").agg(F.count("*").alias("hits")).where(F.col("hits") == F.size("s")))
    each = on.groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("listed") == "block").alias("blocked"))
    return [(tuple(r["s"]), r["n"], r["blocked"]) for r in each.collect()]


def completed(pages: DataFrame, sets: Sequence[tuple[str, ...]], least: float,
              needed: float) -> list[tuple[tuple[str, ...], int, int]]:
    """(tokens, pages, blocked pages) of every minimal rule of (row, listed, tokens) pages, and of more rules.

    ``sets`` are likely rules: those that hold on whole pages are not grown.  No single token is a rule, and no two
    tokens stand on the same pages.
    """
    found = [r for r in counted(pages, sets) if r[2] >= least and r[2] / r[1] >= needed]
    known = matches(F.col("s"), found)
    block = F.col("listed") == "block"
    # a set grows by the page's later tokens only
    held = pages.withColumn("tokens", F.array_sort("tokens")).select(
        "row", "listed", "tokens", F.explode("tokens").alias("token")).select("row", "listed", "tokens", F.array("token").alias("s"))
    alive = stored(held.groupBy("s").agg(F.count("*").alias("n")))
    size, old = 1, [alive]
    while True:
        size += 1
        later = F.filter("tokens", lambda t: t > F.element_at("s", -1))
        grown = (held.select("row", "listed", "tokens", "s", F.explode(later).alias("token"))
                 .withColumn("s", F.concat("s", F.array("token"))).drop("token").where(~known))
        count = grown.groupBy("s").agg(F.count("*").alias("n"), F.count_if(block).alias("blocked")).where(F.col("blocked") >= least)
        part = F.explode(F.transform("s", lambda t: F.array_remove(F.col("s"), t))).alias("part")
        smaller = alive.select(F.col("s").alias("part"), F.col("n").alias("more"))
        free = stored(count.select("s", "n", "blocked", part).join(smaller, "part").where("more > n")
                      .groupBy("s", "n", "blocked").agg(F.count("*").alias("parts")).where(F.col("parts") == size)
                      .select("s", "n", "blocked", (F.col("blocked") / F.col("n") >= needed).alias("rule")))
        found += [(tuple(r["s"]), r["n"], r["blocked"]) for r in free.where("rule").collect()]
        alive = free.where("not rule")
        old.append(free)
        if alive.isEmpty():
            drop(*old)
            return found
        held = stored(grown.join(alive.select("s"), "s").select("row", "listed", "tokens", "s"))
        drop(*old[:-1])
        old = [free, held]


def inverted_index(rules) -> F.Column | None:
    """Map column token -> token sets of its rules; each rule stands under its rarest token."""
    use: dict[str, int] = {}
    for tokens, _, _ in rules:
        for t in tokens:
            use[t] = use.get(t, 0) + 1
    index: dict[str, list] = {}
    for tokens, _, _ in rules:
        index.setdefault(min(tokens, key=lambda t: (use[t], t)), []).append(tokens)
    if not index:
        return None
    pairs = []
    for token, sets in sorted(index.items()):
        pairs += [F.lit(token), F.array(*(F.array(*map(F.lit, s)) for s in sets))]
    return F.create_map(*pairs)


def matches(tokens, rules) -> F.Column:
    """True if some mined rule has all its tokens among ``tokens``."""
    index = inverted_index(rules)
    if index is None:
        return F.lit(False)
    hit = F.exists(tokens, lambda t: F.exists(
        F.coalesce(F.element_at(index, t), F.array().cast("array<array<string>>")),
        lambda s: F.size(F.array_except(s, tokens)) == 0))
    return F.coalesce(hit, F.lit(False))


def filter_urls(pages: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    rows = judged(pages)
    mined = mine(rows.where(F.col("listed").isNotNull()).select("page_id", "tokens", "listed"), min_support, min_confidence,
                 skip=list_tokens())
    other = F.when(matches(F.col("tokens"), mined), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("listed", other).alias("verdict"))
