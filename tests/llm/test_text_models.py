"""Language id and toxicity by held-out accuracy and edge cases; suffix dedup against brute force."""

import gc
import hashlib
import weakref
from collections import Counter

import numpy as np
import pytest

from designlab.llm import langid, suffixes, textarrays, toxicity

from ..conftest import SF_CHECK, SF_SMALL


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = [r for r in langid.report(docs).collect() if r["held_out"] and truth[r["doc_id"]]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in got)
    assert right >= 0.97 * len(got) and all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    rows = [(i, t, x, "z") for i, (t, x) in enumerate([("the cat and the dog", "en")] * 9 + [("der hund und die katze", "de")] * 9)]
    rows += [(50, None, "en", "z"), (51, "", "en", "z"), (52, "12 !!", None, "z"), (53, "the dog", None, "z"),
             (None, "die katze", None, "z"), (54, "the dog " * 100_000, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, held_out string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.report(docs).collect()}
    assert [got[k] for k in (50, 51, 52, 53, None, 54)] == ["und", "und", "und", "en", "de", "en"]
    assert langid.report(docs.limit(0)).count() == 0
    unknown = docs.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.report(unknown).collect()} == {"und"}


def test_toxicity_finds_plain_and_misspelled(spark):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, f"some plain words w{i} " + ("you worthless moron" if toxic else "nice person"), 1.0))
        labels.append((i, int(toxic)))
    rows += [(900, "a WORTHLES thing"), (901, ""), (902, None), (903, "He said \"worthless\" to them"), (None, "moron")]
    rows = [(*r, 1.0) if len(r) == 2 else r for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([*labels, (1, None), (None, 1), (7777, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.report(docs, labels).collect()}
    assert all(got[i] == (i % 4 == 0) for i in range(400))
    assert [got[k] for k in (900, 901, 902, 903, None)] == [1, 0, 0, 0, 1]
    assert toxicity.report(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.report(docs, labels.limit(0)).collect()} == {0.0}


def test_toxicity_small_sample_keeps_the_base_rate(spark):
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 20 == 0
        rows.append((i, f"w{i} plain common usual daily " + ("worthless" if toxic else "nice")))
        labels.append((i, int(toxic)))
    rows += [(9000, "plain common usual daily"), (9001, "plain nice"), (9002, "daily")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    whole, part = toxicity.fit(docs, labels), toxicity.fit(docs, labels, 90)
    # at one size per class every common word would be toxic in half its documents
    assert set(whole[0]) == set(part[0]) == {"worthless"}
    for model in (whole, part):
        got = {r["doc_id"]: r["predicted"] for r in toxicity.predict(docs, model).collect()}
        assert all(got[i] == (i % 20 == 0 and i < 3000) for i in got)


def test_walk_accepts_one_edit():
    terms = ["worthless", "worthy", "idiot", "moron", "stupid"]
    lexicon = toxicity.Lexicon(dict.fromkeys(terms, 1.0))
    for t in terms:
        for k in range(len(t) + 1):
            words = {t[:k] + "x" + t[k:], t[:k] + t[k + 1:], t[:k] + "y" + t[k + 1:]}
            for w in words:
                assert t in lexicon.walk(w) and lexicon.find(w) is not None, (t, w)
    for w in ("idt", "mxrxn", "", "i", "wort", "stupidity", "xxidiot"):
        assert lexicon.walk(w) == [], w


def test_disguised_words_are_matched():
    terms = ["worthless", "idiot", "moron", "stupid", "dumb"]
    lexicon = toxicity.Lexicon(dict.fromkeys(terms, 1.0))
    shares = {(t, k): 0.5 for t in terms for k in toxicity.KINDS}
    for word, term in (("id1ot", "idiot"), ("m0ron!", "moron"), ("(st*pid)", "stupid"), ("ST*PID,", "stupid"), ("*diot", "idiot"),
                       ("moro#", "moron"), ("i.d.i.o.t", "idiot"), ("w0rthless...", "worthless"), ("stu-pid", "stupid"),
                       ("d*mb", "dumb"), ("dum8", "dumb"), ("@umb", "dumb"), ("du.mb", "dumb"), ("dubm", "dumb"), ("*m0ron*", "moron")):
        assert toxicity.hits(f"you {word} there", lexicon) == [(term, "misspelled")], word
        assert toxicity.hits(f'he said "{word}" to me', lexicon) == [(term, "misspelled_quoted")], word
        assert toxicity.combine(toxicity.hits(word, lexicon), shares) == 0.5
    for t in terms:
        for k in range(len(t) - 1):
            swapped = t[:k] + t[k + 1] + t[k] + t[k + 2:]
            assert swapped == t or lexicon.find(swapped) == (t, 1), swapped
    assert toxicity.hits("stupid/moron idiots' idiot2", lexicon) == [
        ("stupid", "exact"), ("moron", "exact"), ("idiot", "misspelled"), ("idiot", "exact")]
    for text in ("1d10t", "a.b", "12:30", "d**b", "bomb", "numb", "http://a.b/c?d=1", "-- * 7", "", None):
        assert toxicity.hits(text, lexicon) == [], text


def brute(rows):
    seen = Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        seen.update(b[k:k + 200] for k in range(len(b) - 199))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = b"\x01" * 200
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [suffixes.BLOCK, 3])
def test_suffixes_edges(spark, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    passage = " ".join(f"p{i * i}" for i in range(90))
    rows = [(i, " ".join(f"{i}w{j}" for j in range(i * 7)) + passage[i % 5:] + f" end{i} " * 40) for i in range(25)]
    rows += [(30, None), (31, ""), (32, "a" * 200), (33, "b" * 201), (34, "ab" * 400), (35, "é日" * 120),
             (None, passage), (36, passage), (36, passage), (37, "c" * 199), (38, passage[:300]), (39, passage[-200:])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, id int")
    got = sorted((tuple(r) for r in suffixes.report(docs).collect()), key=str)
    assert got == brute(rows)
    assert suffixes.report(docs.limit(0)).count() == 0


def test_suffixes_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted((tuple(r) for r in suffixes.report(docs).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_a_sorted_group_is_freed(monkeypatch):
    alive = weakref.WeakSet()
    init = suffixes.Suffixes.__init__

    def tracked(self, *args):
        init(self, *args)
        alive.add(self)

    monkeypatch.setattr(suffixes.Suffixes, "__init__", tracked)
    data = np.frombuffer(("ab" * 150).encode() * 2, np.uint8)
    for _ in range(3):
        found = suffixes.equal_windows(np.array([7, 7]), np.array([5, 5]), data, np.array([0, 300, 600]))
        assert len(found[0]) and len(found[1])
    gc.collect()
    assert not len(alive)


def test_tables_of_powers_fit_their_slices():
    size = textarrays.SLICE + suffixes.LENGTH
    assert len(textarrays.powers(97, size)) == size and textarrays.powers(97, size).base.nbytes <= 8 * (size + 4096)
    assert len(textarrays.powers(97, 3 * size)) == 3 * size


def test_single_anchors_go_first(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{i}w{j}" for j in range(300))) for i in range(6)]
                                 + [(9, "same " * 100), (10, "same " * 100)], "doc_id long, text string")
    kept = []
    stored = suffixes.stored
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffixes, "stored", lambda df: kept.append(stored(df)) or kept[-1])
        patch.setattr(suffixes, "drop", lambda *steps: None)
        suffixes.report(docs).collect()
    every, shared = kept[0], kept[1]
    assert 0 < shared.count() < every.count()
    assert {r["id"] for r in shared.select("id").distinct().collect()} == {9, 10}
