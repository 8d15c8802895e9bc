import math
import random
from itertools import product

import brute
from cases import FOLDER, HARD, documents, duck, hard, nothing, rows_of, same  # noqa: F401
import numpy as np
import pandas as pd

from tidemark.llm import decontaminate, language_id, license_scan, quality_rules, workload

OP6 = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
OP2 = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_scan_of_the_whole_table(spark, duck, documents):
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    same(rows_of(workload.op6_decontamination(spark, FOLDER), *OP6), brute.op6(documents, items))


def test_scan_of_hard_rows_with_one_automaton_and_with_many(spark, hard, nothing):
    items = [(1, "ONE, two!"), (2, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (3, None), (4, "..."), (10, "Été naïve"), (10, "w300 w301")]
    bench = spark.createDataFrame([*items, (None, "w1")], "item_id long, text string")
    wanted = brute.op6(HARD, items)
    for size in (1 << 20, 40):
        found = decontaminate.contamination(hard, bench, automaton_bytes=size)
        same(rows_of(decontaminate.contamination_digest(found), *OP6), wanted)
    assert decontaminate.contamination(nothing, bench).collect() == []
    clean = decontaminate.contamination_digest(decontaminate.contamination(hard, bench.limit(0)))
    same(rows_of(clean, *OP6), brute.op6(HARD, []))


def test_hits_map_to_original_offsets():
    text = "Say: ONE -- Two, (three) four."
    assert [text[a:b] for a, b in decontaminate.offsets_of(text, [{"start": 1, "stop": 3}])] == ["ONE -- Two"]


def test_figures_of_the_whole_table(spark, documents):
    same(rows_of(workload.op2_quality_rules(spark, FOLDER), *OP2), [(d, *brute.op2(t)) for d, t in documents])


def test_figures_of_hard_rows(hard, nothing):
    found = quality_rules.scored(hard)
    same(rows_of(found, *OP2), [(d, *brute.op2(t)) for d, t in HARD])
    assert all(0 <= r["quality"] <= 1 for r in found.collect())
    assert quality_rules.scored(nothing).collect() == []


def test_kept_documents_agree_with_labels(spark):
    kept = {r["doc_id"]: r["kept"] for r in workload.op2_quality_rules(spark, "/root/testdata/sf0.01").where("not base_failed").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    right = [kept[r["doc_id"]] == (r["quality"] == 1) for r in labels if r["doc_id"] in kept]
    assert np.mean(right) >= 0.97


def test_votes_are_weighed_without_labels():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.8
    right = np.array([0.95, 0.9, 0.9, 0.7, 0.85])
    votes = np.where(rng.random((4000, 5)) < right, 1, -1) * np.where(truth, 1, -1)[:, None]
    votes[rng.random(votes.shape) < 0.3] = 0
    good, odds = quality_rules.estimate(votes, np.ones(4000))
    assert abs(good - 0.8) < 0.04
    assert np.mean((quality_rules.posterior(votes, good, odds) >= 0.5) == truth) > 0.95


def test_language_of_held_out_documents(spark):
    found = workload.op5_language_id(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    held = found[found["held_out"]].merge(truth, on="doc_id")
    assert len(found) == len(truth) and (held["lang_pred"] == held["lang"]).mean() >= 0.99
    assert found["score"].between(0, 1).all()


def test_language_of_hard_rows(spark, hard, nothing):
    model = language_id.train(spark.read.parquet(f"{FOLDER}/documents.parquet"), workload.tokenizer_path("piece_bpe_32k.model"))
    found = rows_of(language_id.identify(hard.select("doc_id", "text"), model), "doc_id", "text", "lang_pred", "score")
    assert len(found) == len(HARD)
    for _, text, lang, score in found:
        assert (lang == "und") == (not any(c.isalpha() for c in text or "")) and 0 <= score <= 1
    assert language_id.identify(nothing, model).collect() == []
    empty = language_id.train(nothing, workload.tokenizer_path("piece_bpe_32k.model"))
    assert {r["lang_pred"] for r in language_id.identify(hard, empty).collect()} == {"und"}


def test_numbers_are_no_letters():
    assert language_id.letters("½ ② ² Ⅷ 12 _") == [] and language_id.letters("½ ² 漢 x") == ["½", "²", "漢", "x"]
    assert language_id.letters(None) == language_id.letters("") == []


def test_copies_do_not_thin_the_training_sample(spark):
    few = [(f"{word} number{'abcdefghij'[i]} {word}", lang) for lang, word in (("x", "alpha"), ("y", "omega")) for i in range(10)]
    docs = spark.createDataFrame(few * 500, "text string, lang string")
    path = workload.tokenizer_path("piece_bpe_32k.model")
    model = language_id.train(docs, path, sample=20)
    assert model.languages == ["x", "y"]
    once = language_id.train(spark.createDataFrame(few, "text string, lang string"), path, sample=20)
    assert np.allclose(model.log_p, once.log_p)
    found = language_id.identify(docs.select("text").distinct(), model).collect()
    assert {(r["text"], r["lang_pred"]) for r in found} == set(few)


def test_rare_languages_are_learned(spark):
    names = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(9000)]
    docs = spark.createDataFrame(
        [(f"alpha {n} beta", "x") for n in names] + [(f"omega {n} sigma", "y") for n in names[:2]] + [("delta", "z")], "text string, lang string"
    )
    model = language_id.train(docs, workload.tokenizer_path("piece_bpe_32k.model"), sample=300)
    assert model.languages == ["x", "y", "z"]
    found = language_id.identify(spark.createDataFrame([("omega sigma",), ("alpha beta",), ("delta",)], "text string"), model).collect()
    assert [r["lang_pred"] for r in found] == ["y", "x", "z"]


def test_sample_is_shared_out():
    assert language_id.shared_out([5000, 1000, 200], 3000) == 1800
    assert language_id.shared_out([9000] * 4, 3000) == 750
    assert language_id.shared_out([10, 20], 3000) == 20
    assert language_id.shared_out([900] * 1000, 3000) == language_id.LEAST
    assert language_id.shared_out([], 3000) == 0


def test_words_of_unseen_letters_do_not_underflow():
    keys = np.array(sorted({language_id._hash(bytes([b])) for b in range(256)} | {language_id._hash(b"ab")}), dtype=np.uint64)
    counts = pd.DataFrame([("x", "abab", 10**7), ("y", "cdcd", 10**7), ("z", "ab", 10**7), ("z", "ᚠᚢᚦᚨᚱᚲ" * 4, 1)], columns=["lang", "word", "n"])
    model = language_id.fit(counts, keys)
    place = {int(k): i for i, k in enumerate(keys)}
    rune = "ᚠᚢᚦᚨᚱᚲ" * 9
    single = sum(model.log_p[place[language_id._hash(bytes([b]))]] for b in (" " + rune).encode())
    assert np.allclose(language_id.word_scores([rune], model), [single])  # has no longer piece
    seen = model.log_p[place[language_id._hash("ᚠ".encode()[:1])], model.languages.index("z")]
    assert seen > model.log_p[place[language_id._hash(b"\xff")], model.languages.index("z")] + 1  # learned from a long word
    two = language_id.Model(model.keys, model.log_p[:, :2], model.prior[:2], model.languages[:2])
    texts = pd.Series([f"{rune} {word * 3}" for word in ("abab ", "cdcd ")])
    found = next(language_id.predictor(two).func(iter([texts])))
    assert list(found["lang_pred"]) == ["x", "y"] and found["score"].between(0, 1).all()


def test_forward_pass_sums_all_segmentations():
    pieces = [b" ", b"a", b"b", b" a", b"ab", b"ba", b"aba"]
    hashes = {language_id._hash(p): p for p in pieces}
    keys = np.array(sorted(hashes), dtype=np.uint64)
    rng = np.random.default_rng(2)
    p = rng.random((len(pieces), 2))
    model = language_id.Model(keys, np.log(p), np.zeros(2), ["x", "y"])
    value = {hashes[int(k)]: row for k, row in zip(keys, p, strict=True)}

    def total(data):
        return np.ones(2) if not data else sum((value[q] * total(data[len(q) :]) for q in pieces if data.startswith(q)), np.zeros(2))

    words = ["a", "abab", "bbaa", "abaab"]
    assert np.allclose(np.exp(language_id.word_scores(words, model)), [total(b" " + w.encode()) for w in words])


def test_training_raises_the_likelihood():
    counts = pd.DataFrame([("x", "abab", 5), ("x", "aab", 2), ("y", "bbb", 4), ("y", "ba", 3)], columns=["lang", "word", "n"])
    keys = np.array(sorted(language_id._hash(p) for p in (b" ", b"a", b"b", b"ab", b"bb", b" b")), dtype=np.uint64)

    def likelihood(rounds):
        model = language_id.fit(counts, keys, rounds, smoothing=1e-6)
        scores = language_id.word_scores(list(counts["word"]), model)
        return sum(n * scores[i, model.languages.index(lang)] for i, (lang, n) in enumerate(zip(counts["lang"], counts["n"], strict=True)))

    values = [likelihood(r) for r in range(1, 6)]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False)) and math.isfinite(values[-1])


def test_license_lines_of_the_whole_table(spark, documents):
    wanted = [
        (doc, name, text.index(line))
        for doc, text in documents
        for name, line in license_scan.TEMPLATES.items()
        if line in (text or "")
    ]
    found = workload.op8_license_scan(spark, FOLDER).where("coverage = 1")
    assert set(rows_of(found, "doc_id", "license_id", "start")) >= set(wanted)


def test_license_texts_with_edits(spark, nothing):
    rng = random.Random(3)
    noise = " ".join(f"z{i}" for i in range(40))
    rows, wanted = [], []
    for k, (name, text) in enumerate(license_scan.TEMPLATES.items()):
        words = text.split()
        if len(words) > 20:
            del words[rng.randrange(len(words))]
            words.insert(rng.randrange(len(words)), "extra")
            words[rng.randrange(len(words))] = "changed"
        rows.append((k, f"{noise} {' '.join(words)} {noise}".upper()))
        wanted.append((k, name))
    rows += [(50, None), (51, ""), (52, "this license is free"), (None, license_scan.TEMPLATES["MIT-line"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = license_scan.scanned(docs).collect()
    assert {(r["doc_id"], r["license_id"]) for r in found} >= {*wanted, (None, "MIT-line")}
    assert not {r["doc_id"] for r in found} & {50, 51, 52}
    texts = dict(rows)
    for r in found:
        if r["doc_id"] == 4:
            assert texts[4][r["start"] : r["stop"]].split()[0] == "PERMISSION" and r["coverage"] >= 0.8
    several = license_scan.scanned(docs, index_bytes=100).collect()
    assert sorted(map(repr, several)) == sorted(map(repr, found))
    assert license_scan.scanned(nothing).collect() == []


def test_alignment_within_the_band():
    for template, text in product(["a b c d", "a x c"], ["a b c d", "q a b c d q", "a b z c d"]):
        score, hits, first, last = license_scan.aligned(template.split(), text.split(), -4, 4)
        assert hits <= len(template.split()) and 0 <= first <= last <= len(text.split())
    assert license_scan.aligned("a b c d".split(), "q a b z c d".split(), -4, 4)[1:] == (4, 1, 6)


SHORT = ("MIT-line", "CC-BY-NC-4.0-line", "Apache-2.0-line")


def test_every_notice_of_a_row_of_them(spark):
    rows = [(k, " ".join([license_scan.TEMPLATES[name]] * 1000)) for k, name in enumerate(SHORT)]
    rows.append((9, " zz ".join(license_scan.TEMPLATES[name] for name in SHORT * 50)))
    found = license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")).where("coverage = 1")
    got = sorted((r["doc_id"], r["license_id"], r["first_word"], r["last_word"]) for r in found.collect() if r["license_id"] in SHORT)
    sizes = [len(license_scan.words(license_scan.TEMPLATES[name])) for name in SHORT]
    wanted = [(k, name, n * i, n * i + n - 1) for k, (name, n) in enumerate(zip(SHORT, sizes, strict=True)) for i in range(1000)]
    at = 0
    for name, n in list(zip(SHORT, sizes, strict=True)) * 50:
        wanted.append((9, name, at, at + n - 1))
        at += n + 1
    assert got == sorted(wanted)


def plain_alignments(template, text, percent, shift=0):
    """The best match of all alignments, then those of the words before and after it."""
    best, before = None, {}
    for i, word in enumerate(template):
        row = {}
        for j, other in enumerate(text):
            score, hits, start = before.get(j - 1, (0.0, 0, j))
            cell = (score + (license_scan.MATCH if other == word else license_scan.MISMATCH), hits + (other == word), start)
            for gap in (before.get(j), row.get(j - 1)):
                if gap is not None and gap[0] + license_scan.GAP > cell[0]:
                    cell = (gap[0] + license_scan.GAP, gap[1], gap[2])
            if cell[0] > 0:
                row[j] = cell
                if 100 * cell[1] >= percent * len(template) and (best is None or (-cell[0], -cell[1], i, j) < best[:4]):
                    best = (-cell[0], -cell[1], i, j, cell[2])
        before = row
    if best is None:
        return []
    score, hits, _, last, first = best
    left = plain_alignments(template, text[:first], percent, shift)
    return [*left, (-score, -hits, shift + first, shift + last + 1), *plain_alignments(template, text[last + 1 :], percent, shift + last + 1)]


def test_alignments_of_what_is_left():
    rng = random.Random(4)
    many = 0
    for _ in range(300):
        template = [rng.choice("abcd") for _ in range(rng.randrange(1, 8))]
        text = [w for _ in range(rng.randrange(8)) for w in (*(template if rng.random() < 0.7 else ()), *rng.choices("abcd", k=rng.randrange(3)))]
        wanted = plain_alignments(template, text, 80)
        found = list(license_scan.alignments(template, text, [(-len(template), len(text))], 80))
        assert sorted(found, key=lambda f: f[2]) == wanted
        many += len(wanted) > 3
    assert many > 50
