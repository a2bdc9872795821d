"""Token counts, toxicity, URL rules, decontamination, language model and the pipeline."""

from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import models

import corpus_pipeline
from tallyhouse.llm import language_model as lm
from tallyhouse.llm.decontamination import contaminated, tiles, words
from tallyhouse.llm.queries import URL_RULES
from tallyhouse.llm.token_counts import build_automaton, count_tokens
from tallyhouse.llm.toxicity import fit_toxicity, score_toxicity, swapped_texts
from tallyhouse.llm.url_filter import filter_urls
from tests.llm.fixtures import awkward, awkward_texts, empty


def greedy(word: str, pieces: set[str], start: str) -> int:
    rest, count = start + word, 0
    while rest:
        size = next((n for n in range(len(rest), 0, -1) if rest[:n] in pieces), 0)
        if not size:
            return 0
        rest, count = rest[size:], count + 1
    return count


def test_automaton_counts_like_greedy_search():
    draw = random.Random(2)
    for _ in range(60):
        pieces = {"".join(draw.choices("ab_", k=draw.randint(1, 5))) for _ in range(draw.randint(1, 14))}
        automaton = build_automaton(pieces, "_")
        for _ in range(40):
            word = "".join(draw.choices("abc", weights=[5, 5, 1], k=draw.randint(1, 12)))
            assert automaton.count(word) == greedy(word, pieces, "_")


def test_automaton_agrees_with_a_word_piece_model():
    pieces = {"un": 0, "aff": 1, "able": 2, "affable": 3, "u": 4, "n": 5, "##aff": 6, "##able": 7, "##n": 8, "##a": 9, "[UNK]": 10}
    model = models.WordPiece(pieces, unk_token="[UNK]", max_input_chars_per_word=100)
    own = {p[2:] if p.startswith("##") else "_" + p for p in pieces if p != "[UNK]"}
    automaton = build_automaton(own, "_")
    for word in ("unaffable", "un", "unn", "affable", "unaffx", "affablea", "uaff"):
        assert (automaton.count(word) or 1) == len(model.tokenize(word))


def test_token_counts_of_awkward_texts(spark):
    pieces = ["▁w", "▁", "w", "1", "12", "2", "3", "a", "o", "n", "e"]
    rows = count_tokens(awkward(spark), pieces).collect()
    expected = Counter()
    for key, text in awkward_texts():
        found = [greedy(w.decode(), set(pieces), "▁") for w in (text or "").encode().split()]
        expected[key, len(found), sum(n or 1 for n in found), found.count(0)] += 1
    assert Counter((r.id, r.n_words, r.n_tokens, r.n_unknown) for r in rows) == expected
    assert count_tokens(empty(spark), pieces).count() == 0


def labelled(n: int, biased: bool):
    """Toxic texts have an insult; if biased, most toxic ones and few others name one group."""
    draw = random.Random(4)
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        text = [f"w{draw.randint(0, 300)}" for _ in range(30)]
        if toxic and (not biased or draw.random() < 0.6):
            text.insert(5, draw.choice(["dreadfool", "dreadful-oaf"]))
        if biased and draw.random() < (0.9 if toxic else 0.05):
            text.insert(9, "women")
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxicity_learns_and_spares_neutral_mentions(spark):
    rows = labelled(600, biased=True)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "id long, label int")
    mention = [(1, "w1 w2 women w3"), (2, "w1 w2 dreadfool w3"), (3, None), (4, "")]
    neutral = spark.createDataFrame(mention, "doc_id long, text string")
    plain, fair = ({r.doc_id: r.score for r in score_toxicity(neutral, fit_toxicity(docs, labels, fairness=f)).collect()} for f in (0.0, 20.0))
    assert fair[2] > 0.5 and fair[3] == fair[4] < 0.3
    assert fair[1] < plain[1] and fair[1] < 0.3


def test_swapping_identity_terms():
    groups = [("women", "men", "boys")]
    assert swapped_texts("Women and men.", groups, 2) == ["Men and boys.", "Boys and women."]
    assert swapped_texts("nobody here", groups, 2) == []


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "id long, label int")
    scores = {r.score for r in score_toxicity(awkward(spark), fit_toxicity(awkward(spark), none)).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(0.5)
    assert score_toxicity(empty(spark), fit_toxicity(empty(spark), none)).count() == 0


URLS = [
    ("https://www.Example.NET/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.example.net/de/1", "a.example.net", "/de/1", "net/", "block"),
    ("http://example.com/de/x?y=1#z", "example.com", "/de/x", "example.com/de/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("x://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("http://c.net", "c.net", "", None, "allow"),
    ("http://c.net?x=/en/", "c.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://spam.casino.com/bonus/7", "spam.casino.com", "/bonus/7", None, "block"),
]


def test_url_rules_and_mined_rules(spark):
    bad = [(f"http://s{i % 3}.casino.com/bonus/{i}", True) for i in range(30)]
    good = [(f"http://s{i % 3}.casino.com/news/{i}", False) for i in range(30)] + [(f"http://x.org/bonus/{i}", False) for i in range(40)]
    labels = spark.createDataFrame(bad + good, "url string, blocked boolean")
    pages = spark.createDataFrame([(i, u, "clash") for i, (u, *_) in enumerate(URLS + URLS[:1])], "page_id long, url string, host string")
    rows = {r.page_id: r for r in filter_urls(pages, labels, URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS + URLS[:1]):
        assert (rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) == (host, path, rule, verdict)
    assert set(rows[9].mined_rule) <= {"host casino", "path bonus", "host com", "host spam"} and rows[9].confidence == 1.0


def test_urls_without_labels_or_pages(spark):
    labels = spark.createDataFrame([], "url string, blocked boolean")
    pages = spark.createDataFrame([(u,) for u, *_ in URLS], "url string")
    assert {r.verdict for r in filter_urls(pages, labels, []).collect()} == {"allow"}
    assert filter_urls(pages.limit(0), labels, URL_RULES).count() == 0


def test_tiles_find_reordered_passages():
    item = words(b"a b c d e f g h i j k l m n")
    text = words(b"x h i j k l m n y y a b c d e f g z")
    found = sorted(tiles(item, text, 5))
    assert found == [(0, 10, 7), (7, 1, 7)]
    assert tiles(item, words(b"a b c d"), 5) == [] and tiles(words(b""), text, 5) == []


def test_decontamination(spark):
    draw = random.Random(8)
    item = [f"t{draw.randint(0, 90)}" for _ in range(40)]
    parts = item[20:] + ["x", "y"] + item[:20]
    texts = awkward_texts() + [(50, "lead " + " ".join(item).upper() + " tail"), (51, " ".join(parts)), (52, " ".join(item[:20])), (50, "lead " + " ".join(item).upper() + " tail")]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "again again"), (5, "nowhere to be found at all")], "item_id long, text string")
    rows = contaminated(awkward(spark, texts), benchmark).collect()
    assert sorted((r.id, r.item_id, r.n_covered) for r in rows) == [(14, 4, 2), (15, 4, 2), (50, 1, 40), (51, 1, 40)]
    assert contaminated(empty(spark), benchmark).count() == 0
    assert contaminated(awkward(spark, texts), benchmark.limit(0)).count() == 0


def test_decontamination_folds_accented_capitals(spark):
    item = "el niño comió más piñas y volvió después al jardín über die Straße où l'été était déjà passé"
    apart = unicodedata.normalize("NFD", item)
    texts = [(1, f"antes {item.upper()} luego"), (2, item), (3, apart.title()), (4, "nada de todo eso se encuentra en este otro texto")]
    benchmark = spark.createDataFrame([(1, item), (2, item.upper())], "item_id long, text string")
    rows = contaminated(awkward(spark, texts), benchmark).collect()
    n = len(words(item.encode()))
    assert sorted((r.id, r.item_id, r.n_words, r.n_covered) for r in rows) == [(d, i, n, n) for d in (1, 2, 3) for i in (1, 2)]
    assert words(b"\xff\xc3 AB").tolist() == words(b"\xff\xc3 ab").tolist()


def kneser_ney(training: list[list[bytes]]):
    """Brute force over plain counters: the probability of a word after another."""
    pairs, heads = Counter(), defaultdict(Counter)
    for tokens in training:
        pairs.update(zip([None, *tokens], tokens, strict=False))
    for (h, w), c in pairs.items():
        heads[h][w] = c
    seconds = Counter(w for _, w in pairs)
    vocabulary = {w for tokens in training for w in tokens}
    of = lambda counts: lm.discounts([sum(c == k for c in counts) for k in (1, 2, 3, 4)])
    d, dw, total = of(pairs.values()), of(seconds.values()), sum(seconds.values())
    spare = sum(dw[min(c, 3)] for c in seconds.values()) / total

    def probability(h, w):
        low = max(seconds[w] - dw[min(seconds[w], 3)], 0) / total + spare / (len(vocabulary) + 1)
        if h not in heads:
            return low
        c, n = heads[h][w], sum(heads[h].values())
        return max(c - d[min(c, 3)], 0) / n + sum(d[min(x, 3)] for x in heads[h].values()) / n * low

    return probability


def test_language_model(spark):
    texts = [(k, t) for k, t in awkward_texts() if k is not None]
    tokens = {k: [*(t or "").encode().lower().split(), b" end "] for k, t in texts}
    training = [tokens[k] for k, _ in texts if k % 7 != 2]
    docs = awkward(spark, texts)
    scores, model = lm.train_and_score(docs, docs.where("doc_id % 7 <> 2"))
    probability = kneser_ney(training)
    counts = Counter(w for found in training for w in found)
    assert (model.tokens, model.words, model.texts) == (sum(counts.values()), len(counts), len(training))
    for r in scores.collect():
        found = tokens[r.id]
        assert (r.n_tokens, r.n_known) == (len(found), sum(w in counts for w in found))
        assert r.score == pytest.approx(sum(math.log10(probability(h, w)) for h, w in zip([None, *found], found, strict=False)))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (model.tokens + model.words + 1)) for w in found))
    none, _ = lm.train_and_score(docs, docs.limit(0))
    assert all(np.isfinite(r.score) and r.score == pytest.approx(r.base_score) for r in none.collect())


@pytest.mark.parametrize("count", [2**31 + 5, 2**32 - 1, 2**32])
def test_large_counts_stay_or_raise(spark, tmp_path, count):
    rows = spark.createDataFrame([(0, 7, count - 1), (0, 7, 1)], "part long, key long, c long")
    made = lm._write_ranges(rows, str(tmp_path), 6, lm.Lookup(lm.Model(str(tmp_path), 8, 6, [0])).pairs.value.str)
    if count >= 2**32:
        with pytest.raises(Exception, match="does not fit"):
            made.collect()
    else:
        made.collect()
        found = lm.SortedArrays(str(tmp_path), 6, "<u4").find(np.array([7], np.uint64))
        assert found[2].tolist() == [count]


def test_scrambling_can_be_undone():
    values = np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64)
    assert (lm._unmix(lm.mix(values)) == values).all()


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, left = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, small), f"test-{name}")
        assert docs.columns == columns
        kept = {r.doc_id: r.text for r in docs.collect()}
        assert len(kept) == docs.count() and kept.items() <= left.items()
        if name == "exact_dedup":
            best = {}
            for key, text in left.items():
                best[text] = max(best.get(text, key), key)
            assert set(kept) == set(best.values())
        left = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in packed} == set(left)
    assert {r.doc_id for r in corpus_pipeline.run(spark, small).collect()} == set(left)


AWKWARD = "doc_id long, text string, _id long, _digest string, _toxicity double, _leak int, n int, score string, component long"


@pytest.mark.parametrize("empty_table", [False, True])
def test_pipeline_stages_leave_other_columns_alone(spark, small, empty_table):
    """Whatever the columns are called: rows that stay, stay as they were. Nulls, empty and repeated rows as well."""
    rows = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (4, "one two three four five six")]
    rows += [(None, "lonely words here and there"), (5, "a clean text " * 40), (6, "another clean text " * 3000)]
    table = [(key, text, 7, "d", 0.5, 8, 9, "s", 10) for key, text in rows] if not empty_table else []
    docs = spark.createDataFrame(table, AWKWARD)
    left = Counter(map(tuple, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == docs.columns, name
        docs = corpus_pipeline.staged(kept, f"awkward-{name}")
        now = Counter(map(tuple, docs.collect()))
        assert now <= left, name
        if name == "exact_dedup":
            assert {t[1] or "" for t in now} == {t[1] or "" for t in left} and sum(now.values()) == len({t[1] or "" for t in left})
        left = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in pieces} == {t[0] for t in left}


def test_a_model_whose_files_are_not_there_is_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words of text {i % 3}") for i in range(20)], "doc_id long, text string")
    _, model = lm.train_and_score(docs, docs)
    model.folder = str(tmp_path)
    with pytest.raises(Exception, match="No such file"):
        lm.score(docs, model).collect()
    (tmp_path / "pairs").mkdir()
    with pytest.raises(FileNotFoundError, match="mounted"):
        lm._complete_files(str(tmp_path / "pairs"), 12)
