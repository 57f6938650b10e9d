from __future__ import annotations

import re
import unicodedata
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.llm import language_id, line_crf, quality_rules

TEXTS = st.text(alphabet=st.sampled_from("ab#! .\n\t\rÄé|X9 "), max_size=80)
WORD = re.compile("[^\x20\x09-\x0d]+")


def statistics(text: str) -> tuple:
    w, at, hit = WORD.findall(text), {}, set()
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            hit |= {i + k for i in places for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_statistics_by_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [None, "", " \n\t ", "a b c d e f a b c d e", "x " * 400, "$$ #a\n#a\n \n#a", "🙂 ab", "a\x0bb\x0cc"]
    texts += [" ".join(rng.choice(["a", "bb", "c\n", "d|"], size=n)) for n in rng.integers(0, 120, 60)]
    rows = spark.createDataFrame([(i, t, 5, "z") for i, t in enumerate(texts)] * 2, "doc_id long, text string, n_words long, kept string")
    out = quality_rules.text_statistics(rows).collect()
    assert len(out) == 2 * len(texts)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == statistics(texts[r.doc_id] or "")


def junk(i: int) -> str:
    return " ".join(f"wo{chr(97 + (i + k) % 26)}rd{k}{'$$$' if k % 2 else '###'}" for k in range(60))


def prose(i: int) -> str:
    rng = np.random.default_rng(i)
    return ". ".join(" ".join("".join(rng.choice(list("etaoinshr"), 5)) for _ in range(9)).capitalize() for _ in range(8)) + "."


def test_votes_keep_prose_and_drop_junk(spark):
    rows = [(i, prose(i), "keep") for i in range(60)] + [(100 + i, junk(i), "drop") for i in range(8)] + [(200, None, "drop"), (201, "too short", "drop"), (202, "a b c d e f " * 30, "drop")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, want string, kept string")
    out = quality_rules.judge_quality(df)
    got = out.collect()
    assert len(got) == len(rows) and out.columns[:2] == ["doc_id", "want"]
    assert all(r.kept == (r.want == "keep") for r in got)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if r[2] == "keep")
    assert quality_rules.judge_quality(df.limit(0)).count() == 0


HINDI = "भारत एक विशाल देश है और यहाँ अनेक भाषाएँ बोली जाती हैं। लोग अपने त्योहार मिलकर मनाते हैं। गाँव के बच्चे हर सुबह नदी के किनारे खेलते हैं। क्या आपने उन्हें देखा है?"
FRENCH = "« L’hiver dernier », dit-elle, « j’ai vu qu’il n’était pas d’accord… » C’est l’histoire d’une ville – et d’un fleuve. Aujourd’hui, l’eau n’est plus la même ; on s’en souvient depuis 1997."
URDU = "یہ ایک پرانا شہر ہے، جہاں لوگ دور دور سے آتے ہیں۔ کیا آپ نے یہ شہر دیکھا ہے؟ بازار میں ہر روز نئی چیزیں ملتی ہیں۔ بچے شام کو باغ میں کھیلتے ہیں اور بڑے باتیں کرتے ہیں۔"
RUSSIAN = "«Зима была долгой», — сказал он и закрыл дверь. „Весна“ пришла поздно, но к 12 апреля снег уже сошёл! Дети вышли на улицу, и город снова ожил. Никто больше не вспоминал о холоде и ветре."


def test_clean_texts_of_other_scripts_are_kept(spark):
    texts = [HINDI, FRENCH, URDU, RUSSIAN]
    rows = [(i, prose(i)) for i in range(60)] + [(100 + i, junk(i)) for i in range(8)] + [(200 + i, t) for i, t in enumerate(texts)]
    judged = {r.doc_id: r for r in quality_rules.judge_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        r = judged[200 + i]
        assert (r.n_odd_runs, r.n_stops) == (0, len(re.findall("[.!?…।؟۔]", t))) and r.n_words >= 28 and r.kept
    assert all(judged[k].kept == (k < 60) for k in judged if k < 200)


def test_estimate_matches_enumeration():
    """The mixture's likelihood can't be bettered nearby, and posteriors follow from its parameters."""
    rng = np.random.default_rng(5)
    counts: dict[tuple, int] = {}
    for _ in range(3000):
        good = rng.random() < 0.85
        votes = tuple(int(rng.choice(3, p=[0.02, 0.28, 0.7] if good else [0.7, 0.2, 0.1])) for _ in range(4))
        counts[votes] = counts.get(votes, 0) + 1
    prior, logs = quality_rules.estimate(sorted(counts.items()))
    assert abs(1 / (1 + np.exp(-prior)) - 0.85) < 0.03
    for rule in logs:
        assert abs(np.exp(rule[1][0]) - 0.02) < 0.02 and abs(np.exp(rule[0][0]) - 0.7) < 0.08
    for cls in product(range(2), range(4)):
        assert abs(sum(np.exp(logs[cls[1]][cls[0]])) - 1) < 1e-9


def test_language_on_held_out_rows(spark):
    small = "/root/testdata/sf0.01"
    out = language_id.op9_language_id(spark, small)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = out.collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out and docs[r.doc_id].lang and any(unicodedata.category(c)[0] == "L" for c in docs[r.doc_id].text or "")]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_rejected_rows_are_wrong_more_often(spark):
    """Texts that mix both languages word by word, more of one or of the other: the nearer to half, the surer to be rejected, and the more often wrong."""
    rng = np.random.default_rng(8)
    words = {"en": "the and of thing which with from".split(), "de": "der und ist nicht auch eine von".split()}

    def text(lang: str, share: float, n: int) -> str:
        other = "de" if lang == "en" else "en"
        return " ".join(rng.choice(words[lang if rng.random() < share else other]) for _ in range(n))

    learn = [(i, text(lang := "en" if i % 2 else "de", rng.uniform(0.5, 1), 6), lang) for i in range(1500)]
    asked = [(i, text(lang := "en" if i % 2 else "de", rng.uniform(0.5, 1), 6), lang) for i in range(2000, 4000)]
    schema = "doc_id long, text string, lang string"
    model = language_id.fit(spark.createDataFrame(learn, schema), F.lit(True))
    model.threshold = 0.8
    got = language_id.identify(spark.createDataFrame(asked, schema), model).collect()
    wrong = lambda rows: sum(r.lang != r.lang_pred for r in rows) / len(rows)
    kept, rejected = [r for r in got if not r.rejected], [r for r in got if r.rejected]
    assert len(kept) > 300 and len(rejected) > 300 and wrong(rejected) > 2 * wrong(kept)
    assert abs(sum(r.score for r in got) / len(got) - (1 - wrong(got))) < 0.06  # probabilities are calibrated


def test_language_edge_cases(spark):
    rows = [(i, ("the and of thing " if i % 2 else "der und ist nicht ") * 8, "en" if i % 2 else "de", 1.0) for i in range(80)]
    odd = [(904, "½ ² ① Ⅷ", "en", 0.0), (900, None, None, 0.0), (901, "", None, 0.0), (902, "123 !!", "en", 0.0), (903, "the and thing " * 50_000, None, 0.0), (None, "der und ist", None, 0.0), (None, "der und ist", None, 0.0)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score double")
    model = language_id.fit(df, F.lit(True))
    got = {r.doc_id: r for r in language_id.identify(df, model).collect()}
    assert [got[k].lang_pred for k in (900, 901, 902, 904, 903, None)] == ["und", "und", "und", "und", "en", "de"]
    assert all(got[k].rejected for k in (900, 901, 902, 904))
    empty = language_id.fit(df.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(df, empty).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


def test_language_scores_do_not_depend_on_the_batch():
    rows = [("a" if i % 2 else "b", *language_id.histograms(pa.array([("xyx " if i % 2 else "qwq ") * (3 + i)]))[0]) for i in range(60)]
    model = language_id.train(rows)
    texts = ["xyx", "qwq qwq", "", None, "xyx qwq " * 99]
    whole = model.predict(pa.array(texts))
    single = [model.predict(pa.array([t], pa.string())) for t in texts]
    assert whole[0] == [n[0] for n, _ in single] and np.array_equal(whole[1], [s[0] for _, s in single])


def test_language_scores_by_brute_force(monkeypatch):
    """Mean of the table's rows over all 3- and 4-grams of bytes, whatever the slices."""
    rng = np.random.default_rng(4)
    model = language_id.Model(np.vstack([rng.normal(size=(language_id.BUCKETS, 3)), np.zeros((1, 3))]).astype(np.float32), ["a", "b", "c"])
    texts = ["".join(rng.choice(list("aBé \n漢x"), n)) for n in (0, 1, 2, 3, 4, 5, 50, 3000)] + [None, "ab", "  "]
    for i, text in enumerate(texts):
        b = bytes((text or "").encode()).lower().replace(b"\n", b" ")
        grams = [(n, b[j : j + n]) for n in (3, 4) for j in range(len(b) - n + 1) if b" " not in b[j + 1 : j + n - 1]]
        bucket = {}
        for n, g in set(grams):
            data = np.frombuffer(g, np.uint8)
            bucket[n, g] = int(language_id.subwords(data, np.array([0, n]), 0, n)[n - 3][0][0])
        z = np.mean([model.scores[bucket[g]].astype(float) for g in grams], axis=0) if grams else np.zeros(3)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        for floats in (1 << 21, 4096, 64):
            monkeypatch.setattr(language_id, "SLICE_FLOATS", floats)
            name, score = model.predict(pa.array(texts, pa.string()))
            if any(c.isalpha() for c in text or ""):
                assert abs(score[i] - p.max()) < 1e-5 and (name[i] == model.languages[p.argmax()] or p.max() - np.sort(p)[-2] < 1e-6)
            else:
                assert (name[i], score[i]) == ("und", 0.0)


def chain(e: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Marginals of label 1 by enumeration."""
    weights = {}
    for y in product((0, 1), repeat=len(e)):
        s = sum(e[i] * v for i, v in enumerate(y)) + sum(t[a, b] for a, b in zip(y, y[1:], strict=False))
        weights[y] = np.exp(s)
    z = sum(weights.values())
    return np.array([sum(w for y, w in weights.items() if y[i]) / z for i in range(len(e))])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=4), st.integers(0, 10**6))
def test_marginals_by_enumeration(sizes, seed):
    rng = np.random.default_rng(seed)
    first = np.concatenate([[0], np.cumsum(sizes)])
    e, t = rng.normal(size=first[-1]) * 2, rng.normal(size=(2, 2))
    ahead, back = line_crf.Chains(first).messages(e, t)
    got = 1 / (1 + np.exp(-(ahead + back)))
    want = np.concatenate([chain(e[a:b], t) for a, b in zip(first[:-1], first[1:], strict=True)])
    assert np.allclose(got, want)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_line_features_do_not_depend_on_the_batch(texts):
    f, length, first = line_crf.line_features(pa.array(texts))
    assert first[-1] == sum(t.count("\n") + 1 for t in texts)
    for i, t in enumerate(texts):
        g, l1, _ = line_crf.line_features(pa.array([t]))
        assert np.array_equal(f[first[i] : first[i + 1]], g) and np.array_equal(length[first[i] : first[i + 1]], l1)
        assert l1.tolist() == [len(x.encode()) for x in t.split("\n")]


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = line_crf.op3_line_crf(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in out.collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    bad = [r for r in held if labels[r.doc_id] == 0]
    assert right >= 0.97 * len(held) and sum(r.predicted == 0 for r in bad) >= 0.9 * len(bad)


def path_gradient(features, first, label, weight, p):
    """Log-likelihood of the documents' labels by enumeration of all paths that agree with them."""
    w, t = p[: line_crf.N_FEATURES], p[line_crf.N_FEATURES :].reshape(2, 2)
    e, total = features @ w, 0.0
    for d, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        scores = {y: sum(e[a + i] * v for i, v in enumerate(y)) + sum(t[i, j] for i, j in zip(y, y[1:], strict=False)) for y in product((0, 1), repeat=b - a)}
        agree = [s for y, s in scores.items() if all(y) == (label[d] == 1)]
        total += weight[d] * (np.logaddexp.reduce(agree) - np.logaddexp.reduce(list(scores.values())))
    return total


def test_training_climbs_the_likelihood_of_agreeing_paths():
    rng = np.random.default_rng(2)
    first = np.array([0, 3, 4, 8, 10, 13])
    label = np.array([1, 1, 0, 0, 1])
    features = rng.normal(size=(13, line_crf.N_FEATURES))
    sizes = np.diff(first)
    weight = np.where(label == 1, 0.5 / 3 / sizes, 0.5 / 2)
    start = path_gradient(features, first, label, weight, np.zeros(line_crf.N_FEATURES + 4))
    model = line_crf.train(features, np.ones(13), first, label)
    assert path_gradient(features, first, label, weight, np.concatenate([model.w, model.t.ravel()])) > 0.2 * start
    # one step from zero goes along the numerical gradient
    step = line_crf.train(features, np.ones(13), first, label, steps=1)
    got = np.sign(np.concatenate([step.w, step.t.ravel()]))
    for k in range(line_crf.N_FEATURES + 4):
        d = np.zeros(line_crf.N_FEATURES + 4)
        d[k] = 1e-5
        slope = path_gradient(features, first, label, weight, d) - path_gradient(features, first, label, weight, -d)
        assert abs(slope) < 1e-7 or np.sign(slope) == got[k]


def test_lines_of_a_mixed_text_get_both_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = line_crf.fit(docs, labels)
    rows = docs.join(labels, "doc_id").select("text", "quality").collect()
    good = [x for r in rows if r.quality == 1 for x in r.text.split("\n") if len(x) > 60][:30]
    bad = [x for r in rows if r.quality == 0 for x in r.text.split("\n") if len(x) > 60][:30]
    texts = [(1, "\n".join(good + bad)), (2, "\n".join(bad + good)), (3, "\n".join(good[:15] + bad + good[15:]))]
    want = {1: [True] * 30 + [False] * 30, 2: [False] * 30 + [True] * 30, 3: [True] * 15 + [False] * 30 + [True] * 15}
    lines = line_crf.label_lines(spark.createDataFrame(texts, "doc_id long, text string"), model).orderBy("doc_id", "line_no").collect()
    for k, labels_of in want.items():
        got = [r.good for r in lines if r.doc_id == k]
        assert sum(a == b for a, b in zip(got, labels_of, strict=True)) >= 54, (k, got)


def test_quality_edge_cases(spark):
    docs = [(i, junk(i) if i % 3 == 0 else prose(i), 0.5) for i in range(60)] + [(100, None, 1.0), (101, "", 1.0), (102, "\n" * 5000 + "x", 1.0), (103, "abc " * 200_000, 1.0), (None, "x", 1.0), (1, prose(1), 0.5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(60)] + [(5, None), (None, 1), (6, 0)], "doc_id long, quality int")
    model = line_crf.fit(df, labels)
    got = line_crf.score_quality(df, model).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.5) == (r.doc_id % 3 != 0) for r in got if r.doc_id is not None and r.doc_id < 60)
    assert line_crf.label_lines(df.where("doc_id < 3"), model).count() == sum(t.count("\n") + 1 for i, t, _ in docs if i in (0, 1, 2))
    none = line_crf.fit(df, labels.limit(0))
    assert {r.score for r in line_crf.score_quality(df, none).collect()} == {1.0}
    assert line_crf.score_quality(df.limit(0), model).count() == 0
