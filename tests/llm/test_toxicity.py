from __future__ import annotations

import random
import zlib

import pytest
from helpers import awkward, docs
from pyspark.sql import functions as F

from tidemill.llm import toxicity as tx


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("states", [150_000, 20])
def test_automaton_against_every_term(monkeypatch, states):
    monkeypatch.setattr(tx, "KNOWN_STATES", states)
    random.seed(1)
    terms = ["abcde", "abxde", "bcdefghijkl", "aaaa", "edcba", "abcdefgh"]
    stems = ["bad", "cde"]
    matcher = tx.Matcher([(t, False, 1.0) for t in terms] + [(s, True, 1.0) for s in stems])
    allowed = [0 if len(t) < tx.ONE_EDIT else 1 if len(t) < tx.TWO_EDITS else 2 for t in terms]
    words = ["".join(random.choice("abcdefz") for _ in range(random.randint(0, 9))) for _ in range(4000)]
    words += [t[:i] + random.choice(["", "q", "ab"]) + t[i + random.randint(0, 2) :] for t in terms for i in range(len(t))]
    for word in words:
        near = [(distance(word, t), n) for n, t in enumerate(terms) if distance(word, t) <= allowed[n]]
        near += [(0, len(terms) + n) for n, s in enumerate(stems) if word.startswith(s)]
        got = matcher.find(word)
        assert (got is None) == (not near) and (got is None or got[0] == min(near)[0] and got in near)


@pytest.fixture(scope="module")
def model():
    random.seed(2)
    fill = [f"w{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(600):
        words = random.choices(fill, k=60)
        toxic = i % 6 == 0
        if toxic:
            for _ in range(random.randint(2, 5)):
                words[random.randrange(60)] = random.choice(["horrid", "vile", "grubby", f"mucky{random.randrange(99)}"])
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return tx.fit(texts, labels, 100, 500)


def test_lexicon_is_learned(model):
    terms = {(t, stem) for t, stem, _ in model["lexicon"]}
    assert {("horrid", False), ("vile", False), ("grubby", False), ("mucky", True)} <= terms


def test_words_misspellings_and_quotation(model):
    scorer = tx.Scorer(model)
    fill = " ".join(f"w{i}" for i in range(40))
    score = lambda text: float(scorer.scores([f"{fill} {text} {fill}"])[0])
    clean, abuse = score("kind and nice"), score("Horrid! vile, grubby")
    assert clean < 0.5 < abuse
    assert score("h0rrid grubbby horid") > clean  # misspelled
    assert score("mucky5 mucky77 muckyness") > 0.5  # a stem takes any ending
    assert score('he said "horrid vile grubby" then') < abuse
    assert scorer.matches('they called it "horrid" once')[0][3] and not scorer.matches("a horrid one")[0][3]
    assert scorer.matches("you horrid one")[0][4]


def test_words_of_clean_documents_are_no_misspellings():
    toxic = [{"moron", f"a{i}"} for i in range(40)]
    clean = [{"oron", f"b{i}"} for i in range(60)]
    lexicon = tx.learn_lexicon(toxic, clean)
    assert ("moron", False) in {t[:2] for t in lexicon}
    assert "oron" in tx._usual_forms(lexicon, clean)


def test_without_labels_of_both_kinds():
    for texts, labels in (([], []), (["a"], [0]), (["b"], [1])):
        scorer = tx.Scorer(tx.fit(texts, labels, sum(labels), len(labels) - sum(labels)))
        assert 0 <= scorer.scores(["anything"])[0] <= 1


def labelled(spark, n=300):
    rows = [(i, ("horrid vile " * 3 if i % 4 == 0 else "") + " ".join(f"w{(i * 7 + k) % 90}" for k in range(30))) for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")
    return docs(spark, rows), labels


def test_rows_and_folds(spark):
    frame, labels = labelled(spark)
    model = tx.train(frame, labels)
    found = tx.toxicity(frame.union(docs(spark, awkward())), model)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == 300 + len(awkward())
    for row in rows:
        held = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
        assert row["held_out"] == held and 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    wrong = [r for r in rows[:300] if r["predicted"] != int(r["doc_id"] % 4 == 0)]
    assert not wrong
    assert tx.toxicity(docs(spark, []), model).count() == 0


def test_held_out_labels_have_no_effect(spark):
    frame, labels = labelled(spark)
    turned = labels.withColumn("toxic", F.when(tx.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tx.train(frame, labels) == tx.train(frame, turned.repartition(3))


def test_labels_with_nulls_and_repeats(spark):
    frame, labels = labelled(spark)
    more = spark.createDataFrame([(None, 1, 1), (5, 1, None), (4, None, 0), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    assert tx.train(frame, labels.union(more).union(more))["lexicon"]
    nothing = labels.limit(0)
    assert tx.toxicity(frame, tx.train(frame, nothing)).count() == 300


def test_terms_outside_the_sample_are_learned(spark):
    """The lexicon comes from all labelled rows, each id once, also where the regression takes few of them."""
    rows, labels = [], []
    for i in range(1200):
        rare = " seldom" if i % 40 == 0 else ""
        rows += [(i, ("horrid vile" + rare if i % 4 == 0 else "") + " ".join(f" w{(i * 7 + k) % 90}" for k in range(20)))] * (1 + i % 2)
        labels.append((i, 1, int(i % 4 == 0)))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tx.train(docs(spark, rows), labels, toxic_rows=40, clean_rows=80)
    assert {t for t, _, _ in model["lexicon"]} >= {"horrid", "vile", "seldom"}
    scorer = tx.Scorer(model)
    assert scorer.scores(["w1 w2 seldom w3"])[0] > scorer.scores(["w1 w2 w3"])[0]


@pytest.mark.parametrize("broadcast", [True, False])
def test_distributed_counts_give_the_lexicon_of_all_word_sets(spark, monkeypatch, broadcast):
    """Counted in two steps, with or without a list of terms, and chosen by their beginnings."""
    if not broadcast:
        monkeypatch.setattr(tx, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(tx, "COUNTED", 50)
    monkeypatch.setattr(tx, "KNOWN_BYTES", 4000)
    rng = random.Random(4)
    stems = ["mud", "mudd", "grim", "vil", "ok"]
    rows = []
    for i in range(1500):
        label, fold = int(i % 5 == 0), rng.choice([0, 1, 2, 3, 3, 3])
        words = [f"w{rng.randrange(60)}" for _ in range(12)]
        if label:
            words += [rng.choice(stems) + rng.choice(["", "dy", "e", "er", "ish"]) for _ in range(2)]
        elif rng.random() < 0.05:
            words.append(rng.choice(stems) + "x")
        rows.append((label, fold, " ".join(words) + "."))
    frame = spark.createDataFrame(rows, "a int, b int, c string").repartition(3)
    found = tx.learn_lexicons(frame)
    for fold in range(tx.FOLDS + 1):
        sets = [[], []]
        for label, own, text in rows:
            if own != fold or fold == tx.FOLDS:
                sets[label].append({tx.bare(w) for w in text.split()})
        wanted = {t: t for t in tx.frequent_terms(sets[1], 3)}
        expected = tx.choose_terms([tx.terms_of(s, wanted) for s in sets[1]], [tx.terms_of(s, wanted) for s in sets[0]])
        assert expected and found[fold] == expected


def test_known_words_start_anew(model, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(rng.choice([f"w{rng.randrange(300)}", "horrid", '"vile"', "said", "you", "grubbi"]) for _ in range(50)) for _ in range(60)]
    expected = tx.Scorer(model).scores(texts).tolist()
    monkeypatch.setattr(tx, "KNOWN_BYTES", 500)
    assert tx.Scorer(model).scores(texts).tolist() == expected


def test_lexicon_has_no_limit_of_terms():
    terms = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}q" for i in range(400)]
    toxic = [{t} for t in terms for _ in range(30)]
    clean = [{"fine"}] * 30_000
    assert len(tx.choose_terms(toxic, clean)) == 400


def test_held_out_accuracy(spark):
    """On the largest table of this kind: most toxic documents are found, hardly a clean one is."""
    path = "/root/testdata/sf0.1"
    frame, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    found = tx.toxicity(frame, tx.train(frame, labels)).filter("held_out").join(labels, "doc_id").toPandas()
    toxic = found["toxic"] == 1
    assert found[toxic]["predicted"].mean() > 0.85
    assert found[~toxic]["predicted"].mean() < 0.01
