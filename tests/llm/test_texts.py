"""Quality rules, quality classifier and personal data against brute force and held-out labels."""

import hashlib
import random
import re

import numpy as np
import pytest

from stratamart.llm import personal_data, quality_classifier, quality_rules
from stratamart.llm.lines import repeated_words, word_ids

SYMBOLS = "#*$%&|<>"


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def base_counts(text):
    words = split_words(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    marked = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in text.split("\n") if split_words(x)]
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text), len(lines) - len(set(lines)), len(marked), failed)


def test_base_rules(docs, no_docs, rows):
    found = quality_rules.judged(docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    key = lambda x: (x[0], *map(str, x[1:]))
    assert sorted((tuple(r[c] for c in ["doc_id", *names]) for r in found.collect()), key=key) == sorted(
        ((r[0], *base_counts(r[1] or "")) for r in rows), key=key
    )
    assert all(not r.kept for r in found.collect() if r.base_failed)
    assert quality_rules.judged(no_docs).collect() == []
    kept = quality_rules.retained(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in found.collect() if r.kept)


@pytest.mark.parametrize("seed", range(5))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    words = [bytes([97 + rng.randrange(3)]) for _ in range(rng.randrange(60))]
    text = b" ".join(words).decode()
    assert int(repeated_words(word_ids(words)).sum()) == base_counts(text)[4]


def test_viterbi_is_the_best_path():
    rng = random.Random(4)
    for _ in range(100):
        field = quality_rules.LineField(tuple(rng.uniform(-2, 2) for _ in range(4)), ((rng.random(), rng.random()), (rng.random(), rng.random())))
        patterns = bytes(rng.randrange(4) for _ in range(rng.randrange(1, 8)))
        score = lambda y: sum(field.emission[p] * a for p, a in zip(patterns, y)) + sum(field.pairs[a][b] for a, b in zip(y, y[1:]))
        best = max(score([n >> i & 1 for i in range(len(patterns))]) for n in range(1 << len(patterns)))
        assert score(field.decode(patterns)) == pytest.approx(best)


def test_rules_tell_labelled_documents_apart(spark, docs, sf_dir):
    documents, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    found = quality_rules.judged(documents, quality_rules.trained(documents, labels)).join(labels, "doc_id").collect()
    good = [r for r in found if r.quality == 1 and not r.base_failed]
    bad = [r for r in found if r.quality == 0]
    assert np.mean([r.kept for r in good]) > 0.97 and np.mean([r.kept for r in bad]) < 0.2
    assert quality_rules.trained(documents.limit(0), labels) == quality_rules.DEFAULT_FIELD
    again = quality_rules.trained(documents.repartition(5), labels)
    assert again == quality_rules.trained(documents, labels), "the order of rows says nothing"


def test_classifier_on_held_out_documents(spark, docs, sf_dir):
    documents, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    ranking = quality_classifier.trained(documents, labels)
    found = quality_classifier.scored(documents, ranking).join(labels, "doc_id").where("held_out").collect()
    assert found and np.mean([r.predicted == r.quality for r in found]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    shuffled = labels.selectExpr("doc_id", "IF(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) AS quality")
    assert quality_classifier.trained(documents, shuffled) == ranking, "held-out labels are never read"


def test_classifier_edge_cases(docs, no_docs, nameless, rows, spark):
    labels = spark.createDataFrame([(0, 1), (3, None), (500, 7)], "doc_id long, quality int")
    untrained = quality_classifier.trained(docs, labels)
    assert untrained == quality_classifier.UNTRAINED
    found = quality_classifier.scored(docs, untrained).collect()
    assert len(found) == len(rows) and {r.score for r in found} == {0.5}
    assert quality_classifier.scored(no_docs, untrained).collect() == []
    assert not any(r.held_out for r in quality_classifier.scored(nameless, untrained).collect() if r.doc_id is None)


def test_classifier_learns_from_every_pair(spark, docs, sf_dir, monkeypatch):
    """The ranking is that of all pairs; in small tournaments every row still takes part, and the cut is the exact quantile."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    chosen = documents.join(labels, "doc_id").where(~quality_classifier.held_out()).where("quality in (0, 1)")
    rows = [(quality_classifier.features((r.text or "").encode()), r.quality) for r in chosen.collect()]
    x, quality = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    scale = x.std(0)
    scale[scale < 1e-9] = 1.0
    z = (x - x.mean(0)) / scale
    pairs = (z[quality == 1][:, None] - z[quality == 0]).reshape(-1, z.shape[1])
    found = quality_classifier.trained(documents, labels)
    p = 1 / (1 + np.exp(-np.clip(pairs @ np.array(found.weights), -30, 30)))
    assert np.allclose(pairs.T @ (1 - p), found.weights, atol=1e-3), "the gradient over all pairs is that of the ridge"
    assert np.isclose(found.cut, np.quantile(z @ np.array(found.weights), (quality == 0).mean()))

    monkeypatch.setattr(quality_classifier, "PART", 8)
    monkeypatch.setattr(quality_classifier, "_FEW", 3)
    features = [(i, int(i % 9 > 0), [float((i * k) % 11) for k in range(quality_classifier.N_FEATURES)], 1 + i % 2) for i in range(300)]
    frame = spark.createDataFrame(features, "doc_id long, quality int, x array<double>, times long")
    parts = quality_classifier._tournaments(frame, 266, 34).collect()
    sides = [[np.frombuffer(v) for v in r] for r in parts]
    assert len(parts) > 8 and sum(s[1].sum() for s in sides) == sum(f[3] for f in features if f[1])
    assert all(len(s[1]) and len(s[3]) for s in sides) and max(len(s[1]) for s in sides) < 40
    ranking = quality_classifier.fitted(frame)
    raw = np.repeat(ranking.raw(np.array([f[2] for f in features])), [f[3] for f in features])
    bad = np.repeat([f[1] == 0 for f in features], [f[3] for f in features])
    assert np.isclose(ranking.cut, np.quantile(raw, bad.mean()))


EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(CARD, text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)


@pytest.mark.parametrize("signs", ["a.@-1 ", "01.25 ", "0123456789 -", "+1 ()2.-a", "@.aé"])
def test_base_spans(signs):
    rng = random.Random(signs)
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(40)))
        assert personal_data.base_spans(text) == brute_spans(text), text


def test_very_long_runs_take_linear_time():
    for text in ("1" * 200_000, "@" * 100_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "a." * 50_000 + "@b"):
        personal_data.spans(text, personal_data.DEFAULT_FIELD)


def test_similar_look_alikes_are_added():
    text = "Call +1 (555) 123-4567. Later (555) 123-4567, or 555.123.4567. Order 8890001112. Mail bob.x@mail.com or Bob.X at mail dot com, at home. Yes"
    found = personal_data.spans(text, personal_data.DEFAULT_FIELD)
    assert [(personal_data.KINDS[k], text[a:b]) for a, k, b in found] == [
        ("phone", "+1 (555) 123-4567"), ("phone", "(555) 123-4567"), ("phone", "555.123.4567"),
        ("email", "bob.x@mail.com"), ("email", "Bob.X at mail dot com"),
    ]
    assert set(personal_data.base_spans(text)) <= set(found)
    assert personal_data.masked_text(text, found).startswith("Call [phone]. Later [phone], or [phone]. Order 8890001112. Mail [email] or [email], at")
    assert personal_data.spans("At (555) 123-4567 it stands alone", personal_data.DEFAULT_FIELD) == []


def test_personal_data(spark, docs, no_docs, rows):
    extra = spark.createDataFrame([(9000, "x +1 (555) 123-4567 y a@b.co 10.0.0.1", "en", "s", 5, None, None, None)], docs.schema)
    found = {r.doc_id: r for r in personal_data.personal_data(docs.union(extra)).collect()}
    for doc_id, text in [*((r[0], r[1] or "") for r in rows), (9000, extra.first().text)]:
        base = brute_spans(text)
        own = found[doc_id]
        assert (own.n_email, own.n_ip, own.n_card, own.n_phone) == tuple(sum(k == n for _, k, _ in base) for n in range(4))
        written = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert own.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
    masked = personal_data.masked(docs.union(extra), personal_data.trained(docs.union(extra)))
    assert masked.columns == docs.columns
    row = masked.where("doc_id = 9000").first()
    assert row.text == "x [phone] y [email] [ip]" and row.n_chars == len(row.text)
    assert masked.where("doc_id = 500").first().text is None
    assert personal_data.personal_data(no_docs, personal_data.trained(no_docs)).collect() == []


def test_contradictory_and_repeated_labels(spark, docs, rows):
    """Repeated labels count once, and an id with both labels counts as one without, whatever the order of rows."""
    ids = sorted({r[0] for r in rows})
    plain = [(i, n % 2) for n, i in enumerate(ids[:20])]
    mixed = [*plain, *plain[:5], (ids[21], 0), (ids[21], 1), (None, 1), (ids[22], None)]
    schema = "doc_id long, quality int"
    for module in (quality_rules, quality_classifier):
        expected = module.trained(docs, spark.createDataFrame(plain, schema))
        assert module.trained(docs, spark.createDataFrame(mixed, schema)) == expected
        assert module.trained(docs, spark.createDataFrame(mixed[::-1], schema)) == expected


def test_the_package_as_an_archive(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    import stratamart
    from stratamart.llm.common import packed_package

    path = packed_package(Path(stratamart.__file__).resolve().parents[1], str(tmp_path))
    code = f"import sys; sys.path.insert(0, {path!r}); import stratamart.llm.simhash as m; print(m.__file__)"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert run.stdout.startswith(path), run.stderr
