"""Toxicity: a learned lexicon in a trie, Levenshtein automata over its terms, context windows.

The lexicon holds words whose documents are mostly labelled toxic (lower confidence bound of
that share at least ``MIN_SHARE``), learned from at most ``FIT_ROWS`` labelled documents per class; a class's
sampled documents count by its size over theirs, so that shares are those of all labelled documents.  A text is cut
at white space; a piece is read as its runs of letters and, where digits or symbols stand in it, also
whole without outer punctuation ("id1ot") and by its letters alone ("i.d.i.o.t", which counts as misspelled).
A word matches a term exactly or, from ``FUZZY`` letters on, within one edit (two swapped neighbours are one):
the word's Levenshtein automaton and the trie are walked together, so that only states alive in both are
visited.  Half of such a term must stand at one end of the word, unchanged or swapped across the middle, which
passes over nearly all words before the walk.  Terms of ``SHORT`` letters up to ``FUZZY`` match with swapped neighbours
or one digit or symbol ("d*mb"); with another letter they are mostly another word.  A match
inside quotation marks, or with a reporting word within ``CONTEXT`` words, is a quotation; how
much each kind (exact or misspelled, quoted or not) means is measured on the same labelled documents.
The score is the noisy-or of the three strongest terms, each by its own measured share for its kind.

Defined cases: null and empty texts, and texts without a match, have score 0; rows without a label teach
nothing, a document with contradicting labels counts as toxic; without labels the lexicon is empty and
every score 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from designlab.llm.langid import held_out
from designlab.llm.textarrays import slices

#: labelled training documents of each class at most
FIT_ROWS = 20_000
MIN_DOCS, MIN_DOC_SHARE, MIN_SHARE = 5, 0.005, 0.4
#: terms of the lexicon at most, by confidence bound (part of the fitted model)
TERMS = 5000
FUZZY = 5
SHORT = 3
CONTEXT = 5
CACHE_WORDS = 200_000
WORD = regex.compile(r"\p{L}+(?:['’]\p{L}+)*")
#: white-space-free pieces, as str.split() has them
PIECE = re.compile(r"\S+")
#: a piece without outer punctuation; these symbols stand for letters also at its ends
STANDINS = "@$*#+"
CORE = regex.compile(r"[\p{L}\p{N}@$*#+](?:.*[\p{L}\p{N}@$*#+])?", regex.DOTALL)
#: longer pieces are not remembered
CACHE_LENGTH = 64
# fixed values: reporting words and quotation marks
REPORTING = frozenset("said says wrote writes quote quoted quoting called reported according tweeted replied".split())
OPENING, CLOSING = "\"“«„‘", "\"”»“’"
KINDS = ("exact", "exact_quoted", "misspelled", "misspelled_quoted")


def lower_bound(hits: Column, clean: Column, weights: dict[int, float], z: float = 1.96) -> Column:
    """Lower bound of the toxic share: the Wilson bound among sampled documents, its odds carried to the class sizes."""
    n = (hits + clean).cast("double")
    p = hits / n
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return low * weights[1] / (low * weights[1] + (1 - low) * weights[0])


class Lexicon:
    """Terms with weights, as a trie that words are matched against within one edit."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.trie: dict = {}
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[int, set[str]] = {}
        for t in terms:
            if len(t) >= FUZZY:
                node = self.trie
                for c in t:
                    node = node.setdefault(c, {})
                node[""] = t
                half = len(t) // 2
                self.heads.setdefault(half, set()).update((t[:half], t[:half - 1] + t[half]))
                self.tails.setdefault(len(t) - half, set()).add(t[half:])
        #: misspellings of short terms; a space stands for any digit or symbol
        self.short: dict[str, str] = {}
        for t in sorted((t for t in terms if SHORT <= len(t) < FUZZY), key=lambda t: (terms[t], t)):
            for k in range(len(t)):
                self.short[t[:k] + " " + t[k + 1:]] = t
                if k:
                    self.short[t[:k] + " " + t[k:]] = t
                    self.short[t[:k - 1] + t[k] + t[k - 1] + t[k + 1:]] = t
        self.cache: dict[str, tuple[str, int] | None] = {}
        self.pieces: dict[str, list[tuple[str, int, int, int]]] = {}

    def find(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the best term for a lower-case word."""
        if word in self.terms:
            return word, 0
        if len(word) <= FUZZY and self.short:
            near = self.short.get("".join(c if c.isalpha() else " " for c in word))
            if near:
                return near, 1
        if not any(word[:n] in s for n, s in self.heads.items()) and \
                not any(word[-n:] in s for n, s in self.tails.items()):
            return None
        if word not in self.cache:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            found = self.walk(word)
            self.cache[word] = (max(found, key=lambda t: (self.terms[t], t)), 1) if found else None
        return self.cache[word]

    def readings(self, piece: str) -> list[tuple[str, int, int, int]]:
        """(term, edits, start, end) of every match in a piece without white space."""
        out = self.pieces.get(piece)
        if out is None:
            out = self.read(piece)
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            if len(piece) <= CACHE_LENGTH:
                self.pieces[piece] = out
        return out

    def read(self, piece: str) -> list[tuple[str, int, int, int]]:
        out = []
        runs = [(m.start(), m.end()) for m in WORD.finditer(piece)]
        for start, end in runs:
            found = self.find(piece[start:end].lower())
            if found:
                out.append((*found, start, end))
        core = CORE.search(piece) if runs else None
        if core and core.span() != runs[0]:
            whole = core.group().lower()
            letters = "".join(c for c in whole if c.isalpha())
            found = self.find(whole) or self.find(whole.strip(STANDINS)) or \
                ((letters, 1) if letters in self.terms and len(letters) >= SHORT else None)
            if found and found[0] not in {t for t, *_ in out}:
                out.append((found[0], 1, *core.span()))
        return out

    def walk(self, word: str) -> list[str]:
        """Terms of the trie that the word's automaton (one edit) accepts.

        A state is the positions reached without an edit and with one, and the position from which two
        letters are being swapped; all are followed along the trie.
        """
        end, found = len(word), []
        stack = [(self.trie, 0, frozenset(), None)]
        while stack:
            node, clean, edited, swap = stack.pop()
            for c, child in node.items():
                if c == "":
                    # the rest of the word: nothing, or one surplus letter
                    if end in edited or (clean is not None and end - 1 <= clean <= end):
                        found.append(child)
                    continue
                step = {p + 1 for p in edited if p < end and word[p] == c}
                if swap is not None and word[swap] == c:
                    step.add(swap + 2)
                follow = swapping = None
                if clean is not None:
                    if clean < end:
                        step.add(clean + 1)
                        if word[clean] == c:
                            follow = clean + 1
                    if clean + 1 < end and word[clean + 1] == c:
                        step.add(clean + 2)
                        swapping = clean
                    step.add(clean)
                if follow is not None or step:
                    stack.append((child, follow, frozenset(step), swapping))
        return found


def hits(text: str | None, lexicon: Lexicon) -> list[tuple[str, str]]:
    """(term, kind) of every match in a text."""
    text = text or ""
    # most texts have no match: distinct pieces tell, without places
    if not any(lexicon.readings(p) for p in set(text.split())):
        return []
    words = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    starts = [s for _, s, _ in words]
    out = []
    for m in PIECE.finditer(text):
        for term, edits, start, end in lexicon.readings(m.group()):
            start, end = start + m.start(), end + m.start()
            around = words[max(0, bisect_left(starts, start) - CONTEXT):bisect_left(starts, end) + CONTEXT]
            before, after = text[around[0][1]:start], text[end:around[-1][2]]
            quoted = any(w in REPORTING for w, _, _ in around) or (
                any(c in OPENING for c in text[max(0, around[0][1] - 1):start]) and any(c in CLOSING for c in after)
                and any(c in OPENING for c in before[-80:] or text[max(0, start - 1):start]))
            out.append((term, KINDS[2 * edits + quoted]))
    return out


def combine(matches: list[tuple[str, str]], shares: dict[tuple[str, str], float]) -> float:
    """Noisy-or of the three strongest terms."""
    best: dict[str, float] = {}
    for term, kind in matches:
        best[term] = max(best.get(term, 0.0), shares[term, kind])
    rest = 1.0
    for p in sorted(best.values(), reverse=True)[:3]:
        rest *= 1 - p
    return 1 - rest


def sample_labels(docs: DataFrame, labels: DataFrame,
                  fit_rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """((text, toxic) rows of the training sample, labelled documents per class, sampled ones per class)."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.max("toxic") > 0).cast("int").alias("label")))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in totals.items():
        share = F.when(F.col("label") == k, F.lit(min(1.0, fit_rows / n))).otherwise(share)
    point = F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # at most about 2 * fit_rows ids
    chosen = known.where(point < share)
    sampled = totals
    if any(n > fit_rows for n in totals.values()):
        sampled = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text")
    return texts.join(F.broadcast(chosen), "label_id").select("text", F.col("label").alias("toxic")), totals, sampled


def class_weights(totals: dict[int, int], sampled: dict[int, int]) -> dict[int, float]:
    """Weight of a sampled document of each class; 1 where both classes are sampled at one rate."""
    rate = sum(sampled.values()) / sum(totals.values())
    return {k: rate * totals[k] / sampled[k] if sampled.get(k) else 1.0 for k in (0, 1)}


def fit(docs: DataFrame, labels: DataFrame,
        fit_rows: int = FIT_ROWS) -> tuple[dict[str, float], dict[tuple[str, str], float]]:
    """(lexicon terms with their toxic share, share per term and kind of match)."""
    rows, totals, sampled = sample_labels(docs, labels, fit_rows)
    if not sampled.get(1):
        return {}, {}
    weights = class_weights(totals, sampled)

    def words(batches):
        for batch in batches:
            for part in slices(batch):
                found, toxic = [], []
                for text, y in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    own = {w.lower() for w in set(WORD.findall(text or ""))}
                    found += own
                    toxic += [y] * len(own)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(toxic, pa.int32())],
                                                 names=["word", "toxic"])

    need = max(MIN_DOCS, int(MIN_DOC_SHARE * sampled[1]))
    bound = lower_bound(F.col("hits"), F.col("clean"), weights)
    counts = (rows.mapInArrow(words, "word string, toxic int").groupBy("word")
              .agg(F.sum("toxic").alias("hits"), F.sum(1 - F.col("toxic")).alias("clean"))
              .where(F.col("hits") >= need).withColumn("bound", bound).where(F.col("bound") >= MIN_SHARE)
              .orderBy(F.desc("bound"), F.desc("hits"), "word").limit(TERMS).collect())

    def weighted(r) -> tuple[float, float]:
        """(toxic, all) documents of a row of counts, by weight."""
        toxic = weights[1] * r["hits"]
        return toxic, toxic + weights[0] * r["clean"]

    terms = {r["word"]: weighted(r)[0] / weighted(r)[1] for r in counts}

    def kinds(batches):
        lexicon = Lexicon(terms)
        for batch in batches:
            for part in slices(batch):
                term, kind, toxic = [], [], []
                for text, y in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                    for t, k in set(hits(text, lexicon)):
                        term.append(t)
                        kind.append(k)
                        toxic.append(y)
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(kind, pa.string()),
                                                  pa.array(toxic, pa.int32())], names=["term", "kind", "toxic"])

    seen = {(r["term"], r["kind"]): r for r in
            rows.mapInArrow(kinds, "term string, kind string, toxic int").groupBy("term", "kind")
            .agg(F.sum("toxic").alias("hits"), F.sum(1 - F.col("toxic")).alias("clean")).collect()}
    # priors, worth four documents: a quotation counts as the base rate, a misspelling as half the term
    base = totals[1] / sum(totals.values())
    shares = {}
    for term, share in terms.items():
        for kind, prior in zip(KINDS, (share, base, share / 2, base), strict=True):
            toxic, total = weighted(seen[term, kind]) if (term, kind) in seen else (0.0, 0.0)
            shares[term, kind] = (toxic + 4 * prior) / (total + 4)
    return terms, shares


def predict(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        terms, shares = shared.value
        lexicon = Lexicon(terms)
        for batch in batches:
            for part in slices(batch):
                scores = [combine(hits(t, lexicon), shares) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()),
                     pa.array([int(s >= 0.3) for s in scores], pa.int32())],
                    names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return predict(docs, fit(docs, labels))
