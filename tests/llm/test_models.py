import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import luhn as brute_luhn
from brute import pii as brute_pii
from pyspark.sql import functions as F

from tidemark.llm import language_model, media, pii, quality, toxicity
from tidemark.llm.boosting import Boosted, Isotonic

EDGES = [(1, None), (2, ""), (2, "again"), (None, "null key"), (4, "word " * 30000), (5, "é😀\n\n..."), (5, "é😀\n\n...")]


def frame(spark, rows, parts=2):
    made = [(i, t, None, None, None, "x", 1.0) for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long, media string, score double").repartition(parts)


PII_ROWS = [
    (1, "a@b.co_x@y.com a@b 1.2.3.4.5.6.7.8 😀 +1 (988) 555-2485x 4111 1111 1111 1111 é"), (2, None), (3, ""), (4, "9 " * 20000 + "1.2.3.300 " + "a.b" * 3000),
    (5, "@b.c 1234"), (None, "+49 30 1234567"), (1, "a@b.co"), (7, "x" * 100000 + "@" + "a." * 30000 + "c"), (8, "--- +1-- 12 34 56 78 90 1 00.0.0.0255 00000000000000000"),
    (9, "ab@c.d.e 12 "),
]


def test_base_spans(spark):
    got = sorted((r["base_sha256"], r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]) for r in _pii(spark, PII_ROWS))
    want = sorted((hashlib.sha256(",".join(brute_pii(t)).encode()).hexdigest(), len(brute_pii(t))) for _, t in PII_ROWS)
    assert got == want


def _pii(spark, rows):
    found = pii.redactions(frame(spark, rows))
    base = {k: F.col(f"base_{k}") for k in pii.KINDS}
    return found.select("doc_id", *[F.size(base[k]).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii._written(base), 256).alias("base_sha256"), pii._written({k: F.col(f"all_{k}") for k in pii.KINDS}).alias("spans")).collect()


def test_added_spans_and_redaction(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        n = "".join(str(rnd.randrange(10)) for _ in range(15))
        card = next(n + c for c in "0123456789" if (c2 := n + c) and sum(v - 9 * (v > 9) for v in (int(x) * (1 + j % 2) for j, x in enumerate(reversed(c2)))) % 10 == 0)
        rows.append((i, f"call +1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)} or {card} and {n}1 at 10.{rnd.randrange(256)}.3.{rnd.randrange(256)} from 400.1.2.{i % 200}"))
    rows.append((999, "call 1 (212) 555-1234 soon"))
    found = {r["doc_id"]: r["spans"] for r in _pii(spark, rows)}
    assert "phone:5:21" in found[999]
    for i, t in rows[:300]:
        assert set(brute_pii(t)) <= set(found[i].split(","))
    masked = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows[:50] + [(400, None), (401, "😀 a@b.co 😀")])).collect()}
    assert masked[401] == "😀 ****** 😀" and masked[400] == "" and "555" not in masked[3] and len(masked[3]) == len(rows[3][1])
    assert not _pii(spark, [])


def plain_added(text, model):
    """Added spans by kind: every proposal, its features and its trees' sum, one at a time."""
    base = [(k, int(a), int(z)) for k, a, z in (x.split(":") for x in brute_pii(text))]
    digits = lambda m: re.sub("[^0-9]", "", m)
    spans = []
    for run in re.finditer(pii._NUMBER, text):
        s, e = run.span()
        near = re.match(r"[0-9 ().,+-]*", text[s : s + 2 * pii._REACH + 1])[0]
        groups = [(s + g.start(), s + g.end()) for g in re.finditer("[0-9]+", near)]
        if s and text[s - 1].isdigit():
            groups = [g for g in groups if g[0] != s]
        mine = [(s, e)]
        for a in groups:
            for b in groups:
                n = sum(z - y for y, z in groups if a[0] <= y <= b[0])
                if a[0] < e and b[0] >= a[0] and b[1] - a[0] <= pii._REACH and 7 <= n <= 19:
                    mine.append((a[0] - len(re.search(r"[+(]{0,2}$", text[max(a[0] - 2, 0) : a[0]])[0]), b[1]))
        spans += dict.fromkeys(mine)
    fits = {"ip": lambda m: 4 <= len(re.split("[^0-9]+", m)) <= 5 and len(digits(m)) <= 12, "card": lambda m: 12 <= len(digits(m)) <= 19, "phone": lambda m: 7 <= len(digits(m)) <= 15}
    asked = [("email", *m.span()) for m in re.finditer(pii._ADDRESS, text)] + [(k, s, e) for k, ok in fits.items() for s, e in spans if ok(text[s:e])]
    out = {k: [] for k in pii.KINDS}
    for kind, s, e in asked:
        m, d = text[s:e], digits(text[s:e])
        meets = [(k, k == kind) for k, a, z in base if a < e and s < z]
        octets = re.fullmatch(r"0*\d{1,3}(?:[.,] ?0*\d{1,3}){3}", m) and all(int(x) <= 255 for x in re.findall("[0-9]+", m))
        before = text[max(s - 40, 0) : s].lower()
        row = {
            "kind": pii.KINDS.index(kind), "digits": min(len(d), 20), "seps": min(len(re.sub("[0-9A-Za-z]", "", m)), 8), "groups": min(len(re.findall("[0-9]+", m)) if kind != "email" else len([g for g in re.split("[^0-9]+", m) if g]), 6),
            "luhn": int(12 <= len(d) <= 19 and brute_luhn(d)), "paren": int(bool(re.search(r"[()\[\]]", m))), "octets": int(bool(octets)),
            "ctx": int(bool(re.search(rf"(?:^|[^a-z])(?:{pii._ANNOUNCE[kind]})[^0-9]{{0,20}}$", before))), "edge": int(bool(re.search("[A-Za-z0-9=_/]", text[max(s - 1, 0) : s] + " " + text[e : e + 1]))),
        }
        broken = {"ip": not row["octets"], "card": not row["luhn"] or len(d) < 13, "phone": len(d) < 9 or (row["groups"] == 1 and not row["ctx"])}.get(kind, False)
        if meets or broken or row["edge"] or plain_trees(model.trees, [row[f] for f in pii.FEATURES]) < model.least[pii.KINDS.index(kind)]:
            continue
        out[kind].append((s, e))
    return ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in sorted(out[k] + [(a, z) for b, a, z in base if b == k]))


def test_added_spans_against_plain_proposals(spark):
    rnd = random.Random(21)
    number = lambda n: "".join(str(rnd.randrange(10)) for _ in range(n))

    def card():
        n = number(15)
        return next(n + c for c in "0123456789" if brute_luhn(n + c))

    makers = [
        lambda: f"call +1 ({number(3)}) 555-{number(4)}", lambda: f"card {card()}", lambda: f"10.{rnd.randrange(300)}.3.{rnd.randrange(300)}", lambda: f"id {number(16)}", lambda: f"tel ({number(3)}) {number(3)}-{number(4)}",
        lambda: f"{card()} {card()}", lambda: f"host 10,{rnd.randrange(256)},4,{rnd.randrange(256)}", lambda: f"mail ann{number(2)} [at] site{number(1)} [dot] org", lambda: f"x{number(2)}@site.co.uk", lambda: f"ref={number(12)}", lambda: f"{number(4)}-{number(4)}-{number(4)}-{number(4)}",
    ]
    rows = [(i, " é ".join(rnd.choice(makers)() for _ in range(rnd.randint(1, 4)))) for i in range(400)]
    table = pii.span_table(frame(spark, rows))
    model = pii.SpanModel.fit(table)
    found = {r["doc_id"]: r["spans"] for r in pii._selected(table, model, "doc_id").select("doc_id", pii._written({k: F.col(f"all_{k}") for k in pii.KINDS}).alias("spans")).collect()}
    assert {i: plain_added(t, model) for i, t in rows} == found
    assert sum(len(found[i].split(",")) - len(brute_pii(t)) for i, t in rows if found[i]) > 50


def test_pii_plan_runs_no_python(spark):
    plan = pii._span_rows(frame(spark, PII_ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_media_round_trip(spark):
    got = media.fingerprints(media.to_wav(frame(spark, EDGES))).collect()
    texts = sorted((t or "").encode() for _, t in EDGES)
    assert sorted(r["n_bytes"] for r in got) == sorted(map(len, texts))
    by_size = {r["n_bytes"]: r for r in got}
    for raw in texts:
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = by_size[len(raw)]
        assert r["payload_sha256"] == hashlib.sha256(padded).hexdigest() and r["tail_crc32"] == zlib.crc32(padded[-64:])
        assert r["media_bytes"] == len(media.wav_bytes(padded)) and media.wav_payload(media.wav_bytes(padded)) == padded
    rnd = random.Random(3)
    prose = media.fingerprints(media.to_wav(frame(spark, [(1, " ".join(rnd.choice(["one", "seven", "eleven"]) for _ in range(3000)))]))).first()
    assert len(prose["print_times"]) == len(prose["print_codes"]) > 0
    assert media.fingerprints(media.to_wav(frame(spark, []))).count() == 0


def plain_prints(payload):
    """Peak pairs by a discrete Fourier transform written out."""
    size, hop, bands = media.FRAME, media.HOP, media.BANDS.tolist()
    samples = [b - 128 for b in payload]
    window = np.hanning(size)
    turn = np.exp(-2j * np.pi * np.outer(np.arange(size // 2 + 1), np.arange(size)) / size)
    found = []
    for k in range(max(1, 1 + -(-(len(samples) - size) // hop))):
        part = samples[k * hop : k * hop + size]
        power = np.abs(turn @ (window * np.array(part + [0] * (size - len(part)))))
        level = 1.5 * power[bands[0] :].mean()
        best = [lo + int(power[lo:hi].argmax()) for lo, hi in zip(bands, bands[1:])]
        found.append([b if power[b] > level else None for b in best])
    pairs = []
    for t, here in enumerate(found):
        for step in range(1, media.REACH + 1):
            for band, b in enumerate(here):
                other = found[t + step][(band + 1) % len(here)] if t + step < len(found) else None
                if b is not None and other is not None:
                    pairs.append((t, b << 13 | other << 4 | step))
    return sorted(pairs)


def test_prints_against_a_plain_transform(spark):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choice(["one", "seven", "eleven", "Ä!"]) for _ in range(n))) for i, n in enumerate([0, 3, 120, 400, 900])] + [(9, None)]
    got = {r["doc_id"]: r for r in media.fingerprints(media.to_wav(frame(spark, rows))).collect()}
    for i, t in rows:
        pairs = plain_prints(media.pad((t or "").encode()))
        assert list(zip(got[i]["print_times"], got[i]["print_codes"], strict=True)) == pairs
        mark = hashlib.sha256(np.array([p[0] for p in pairs], "<i4").tobytes() + np.array([p[1] for p in pairs], "<i4").tobytes()).hexdigest()
        assert got[i]["feature"] == f"{len(pairs)}:{mark[:32]}"


def test_peaks_find_a_tone():
    t = np.arange(8192)
    payload = (128 + 100 * np.sin(2 * np.pi * 60 / media.FRAME * t)).astype(np.uint8).tobytes()
    assert (media.peaks(payload)[:, 2] == 60).mean() > 0.9


def test_boosting_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = Boosted.fit(x[:1500], y[:1500])
    assert ((trees.raw(x[1500:]) > 0) == (y[1500:] == 1)).mean() > 0.95
    curve = Isotonic(trees.raw(x), y)
    p = curve(np.linspace(-9, 9, 50))
    assert (np.diff(p) >= 0).all() and 0 <= p.min() and p.max() <= 1
    assert Boosted.fit(x[:0], y[:0]).raw(x[:2]).shape == (2,)


def _labelled(n=600, seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    rows, toxic = [], []
    for i in range(n):
        w = [word() for _ in range(rnd.randint(20, 200))]
        if bad := rnd.random() < 0.2:
            for _ in range(4):
                w.insert(rnd.randrange(len(w)), rnd.choice(["zorgling", "quaxter", "vemp" + word(), "zo1rgling"]))
        rows.append((i, " ".join(w)))
        toxic.append((i, int(bad)))
    return rows, toxic


def test_toxicity(spark):
    rows, toxic = _labelled()
    marks = spark.createDataFrame([*toxic, (None, 1), (3, None)], "doc_id long, toxic int")
    docs = frame(spark, rows + [(9001, None), (9002, ""), (None, "x")])
    model = toxicity.fit(docs, marks)
    got = {r["doc_id"]: r["tox_score"] for r in toxicity.scored(docs.select("doc_id", "text"), model).collect()}
    held = [i for i, _ in toxic if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [(got[i] >= 0.5) == bool(dict(toxic)[i]) for i in held]
    assert len(got) == 603 and np.mean(right) > 0.95 and got[9001] == got[9002] and 0 <= min(got.values()) and max(got.values()) <= 1
    empty = toxicity.fit(docs, marks.limit(0))
    assert {r["tox_score"] for r in toxicity.scored(docs.select("doc_id", "text"), empty).collect()} and toxicity.scored(docs.limit(0), empty).count() == 0
    with pytest.raises(ValueError):
        toxicity.scored(docs.withColumn("tox_score", F.lit(1.0)), empty)


def plain_trees(trees, x):
    """The sum of boosted trees, by walking each."""
    total = trees.base
    for feature, cut, value in trees.trees:
        k = 0
        while k < len(feature) and feature[k] >= 0:
            edges = trees.edges[feature[k]]
            k = 2 * k + 1 + (int(sum(e < x[feature[k]] for e in edges)) > cut[k])
        total += value[k]
    return total


def plain_signs(text, table):
    """The toxicity features of a text, counted word by word."""
    words = ["".join(g) for g in re.findall(r"[^\W_]+", text.lower())]
    n, kind = max(len(words), 1), []
    for w in words:
        units = [u for u in [w, *(f"{w[:k]}*" for k in toxicity.STEMS if len(w) > k)] if u in table.entries]
        kind.append(max(units, key=table.entries.get) if units else "you" if w in toxicity.SECOND_PERSON else None)
    hits = [i for i, k in enumerate(kind) if k not in (None, "you")]
    you = [i for i, k in enumerate(kind) if k == "you"]
    weights = [table.entries[kind[i]] for i in hits]
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in hits)
    count = lambda chars: sum(text.count(c) for c in chars)
    upper, lower = (sum(a <= c <= z for c in text) for a, z in (("A", "Z"), ("a", "z")))
    letters, distinct = max(upper + lower, 1), len({kind[i] for i in hits})
    mixed = toxicity._MIXED.findall(text) if re.search(r"[0-9!#$*\-.@_]", text) else []
    listed = lambda w: any(u in table.entries for u in toxicity.units({w}))
    hidden = sum(listed(re.sub(r"[\W_]+|\d+", "", m.lower().translate(toxicity._PLAIN))) and not listed(m.lower()) for m in mixed)
    return [
        len(hits), len(hits) / n, distinct, distinct / n, sum(weights), max(weights, default=0.0), near, near / n, len(you) / n,
        upper / letters, count("!") / n, count("!\"',.:;?") / n, hidden, len(mixed) / n, np.log1p(len(words)),
    ]


def test_toxicity_scores_against_plain_trees(spark):
    rows, toxic = _labelled(300, 5)
    rows = [(i, t + (" You are QUAXTER! zo1rgling" if i % 7 == 0 else "")) for i, t in rows] + [(900, None), (901, "")]
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(toxic, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["tox_score"] for r in toxicity.scored(frame(spark, rows).select("doc_id", "text"), model).collect()}
    for i, t in rows:
        raw = plain_trees(model.trees, plain_signs(t or "", model.table))
        want = 0.999 * float(model.curve(np.array([raw]))[0]) + 0.001 / (1 + np.exp(-raw))
        assert abs(got[i] - want) < 1e-9


def test_quality_scores_against_plain_sums(spark):
    """Each view's probability from its weights, one indicator at a time."""
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice("abcdef") * rnd.randint(1, 6) + ("%%" if i % 3 == 0 else "") for _ in range(rnd.randint(1, 60)))) for i in range(240)] + EDGES
    docs = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "xx").otherwise("de")).withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 5).cast("string"))).withColumn("n_chars", F.length("text").cast("long"))
    table = quality.view_table(docs)
    views = quality.fit(table, spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(0, 240, 2)], "doc_id long, quality int"))
    texts = {i: (t or "") for i, t in rows}
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    for r in quality.score(table, views).join(docs.select("doc_id", "lang", "source", "n_chars"), "doc_id").filter("doc_id > 5").collect():
        xt = quality.text_view(texts[r["doc_id"]])
        text = views.w[0][-1] + sum(views.w[0][k * quality.BINS + int(sum(e < x for e in views.edges[k]))] for k, x in enumerate(xt))
        meta = views.w[1][-1] + sum(views.w[1][k] for k in quality.meta_view(r["lang"], r["source"], r["n_chars"]))
        z = [text * views.platt[0][0] + views.platt[0][1], meta * views.platt[1][0] + views.platt[1][1]]
        joint = views.joint[0] * z[0] + views.joint[1] * z[1] + views.joint[2]
        assert np.allclose([r["text_score"], r["meta_score"], r["score"]], [sigmoid(z[0]), sigmoid(z[1]), sigmoid(joint)], atol=1e-9)


def test_quality(spark):
    rnd = random.Random(4)
    rows, marks = [], []
    for i in range(500):
        bad = rnd.random() < 0.3
        w = [rnd.choice("abcdef") * rnd.randint(1, 6) for _ in range(60)]
        rows.append((i, " ".join(f"{x}%%%" for x in w) if bad else " ".join(w)))
        if i % 2:
            marks.append((i, int(not bad)))
    docs = frame(spark, rows + EDGES)
    table = quality.view_table(docs)
    labelled = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score(table, quality.fit(table, labelled)).collect()}
    bad = {i for i, t in rows if "%%%" in t}
    assert np.mean([(got[i]["score"] < 0.5) == (i in bad) for i, _ in rows if i % 2 == 0 and i > 5]) > 0.95
    none = quality.score(table, quality.fit(table, labelled.limit(0))).collect()
    assert {r["score"] for r in none} == {0.5} and len(none) == len(rows) + len(EDGES)
    assert quality.view_table(docs.limit(0)).count() == 0


def test_language_model(spark):
    rnd = random.Random(6)
    rows = [(100 + i, " ".join(rnd.choice(["the cat sat on a mat", "a dog ran to the park"]) for _ in range(30))) for i in range(120)]
    coded, net = language_model.fit(frame(spark, rows + EDGES))
    got = {r["doc_id"]: r for r in language_model.score(coded, net).collect()}
    common = [b"a", b"cat", b"dog", b"mat", b"on", b"park", b"ran", b"sat", b"the", b"to"]
    assert language_model.score(language_model.encode(frame(spark, rows[:2]), common), net).count() == 2
    assert got[103]["n_words"] == 30 * 6 and got[103]["mean_log_prob"] > -2.2  # ten words alike would give -2.3
    blank = [r for r in language_model.score(coded, net).collect() if r["n_words"] == 0]
    assert len(blank) == sum(not (t or "").split() for _, t in EDGES) and all(r["mean_log_prob"] is None for r in blank)
    context = language_model.windows(np.frombuffer(b"\x01\x02\x03", np.uint8))
    assert context.tolist() == [[0, 0, 2, 3], [0, 1, 3, 0], [1, 2, 0, 0]]
    p = np.exp([net.log_probs(context[:1], np.array([c])) for c in range(language_model.CLASSES)]).sum()
    assert abs(p - 1) < 1e-3
    coded, net = language_model.fit(frame(spark, []))
    assert language_model.score(coded, net).count() == 0


def test_pseudo_likelihood_against_plain_sums(spark):
    """log P(class | two words on each side), position by position from the weights, plus log of the word's share of its class."""
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choice(["a", "b", "c", "dd", "ee"]) + str(rnd.randrange(40)) for _ in range(rnd.randint(1, 60)))) for i in range(60)] + [(100, "alone"), (101, None)]
    coded, net = language_model.fit(frame(spark, rows))
    classes = {r["doc_id"]: (list(r["classes"]), r["within"]) for r in coded.collect()}
    for r in language_model.score(coded, net).collect():
        seq, total = classes[r["doc_id"]]
        for k, target in enumerate(seq):
            z = net.inner.astype(float)
            for j, o in enumerate(language_model.OFFSETS):
                z = z + net.tables[j][seq[k + o] if 0 <= k + o < len(seq) else 0]
            logits = np.tanh(z) @ net.out + net.bias
            total += logits[target] - np.log(np.exp(logits).sum())
        assert r["n_words"] == len(seq) and abs(r["log_prob"] - total) < 1e-3 * max(1, len(seq))


def test_language_model_scores_words_within_their_class(spark):
    """The word's share of its class, from counts over all texts, is part of the score; words of one hashed class differ by it."""
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(rnd.choices(words, [1 / (1 + k) for k in range(400)], k=200))) for i in range(40)] + [(900, "junkjunk"), (901, None)]
    coded, net = language_model.fit(frame(spark, rows, 3))
    got = {r["doc_id"]: r for r in coded.collect()}
    counts, of = Counter(w for _, t in rows for w in (t or "").split()), {}
    for i, t in rows:
        of.update(zip((t or "").split(), got[i]["classes"], strict=True))
    per = Counter()
    for w, n in counts.items():
        per[of[w]] += n
    for i, t in rows:
        assert abs(got[i]["within"] - sum(np.log(counts[w] / per[of[w]]) for w in (t or "").split())) < 1e-6
    assert sum(n == 1 for n in Counter(of.values()).values()) >= language_model.OWN and len(of) == len(counts)
    score = {r["doc_id"]: r["log_prob"] for r in language_model.score(coded, net).collect()}
    context = language_model.windows(np.frombuffer(got[900]["classes"], np.uint8))
    assert abs(score[900] - net.log_probs(context, np.frombuffer(got[900]["classes"], np.uint8))[0] - np.log(1 / per[of["junkjunk"]])) < 1e-4


def test_every_position_is_a_training_target_once():
    rows = [bytes([1 + i % 9] * n) for i, n in enumerate([0, 1, 2, 3, 7, 8, 9, 500])]
    for row in rows:
        taught = [language_model.targets(row, r, language_model.ROUNDS) for r in range(language_model.ROUNDS)]
        assert sum(len(t) for _, t in taught) == len(row) and all(len(c) == len(t) for c, t in taught)
    c = np.arange(1, 60, dtype=np.uint8)
    taught = [language_model.targets(c.tobytes(), r, language_model.ROUNDS) for r in range(language_model.ROUNDS)]
    order = np.argsort(np.concatenate([t for _, t in taught]))
    assert (np.concatenate([x for x, _ in taught])[order] == language_model.windows(c)).all()


def test_neighbouring_numbers_are_proposed_apart(spark):
    """Runs of more digits than any kind has: their groups are candidates of their own, and valid cards are selected."""
    rnd = random.Random(12)

    def card():
        n = "".join(str(rnd.randrange(10)) for _ in range(15))
        return next(n + c for c in "0123456789" if sum(v - 9 * (v > 9) for v in (int(x) * (1 + j % 2) for j, x in enumerate(reversed(n + c)))) % 10 == 0)

    def laid(n, i):
        return ["", " ", "-"][i % 3].join(n[k : k + 4] for k in range(0, 16, 4))

    rows = [(i, f"{'card' if i % 2 else 'paid'} {laid(card(), i)} and {'visa' if i % 5 else ''} {laid(str(rnd.randrange(10**15, 10**16)), i // 3)} or {'x' * (i % 2)}{rnd.randrange(10 ** (12 + i % 7))} at +1 ({rnd.randrange(200, 999)}) 555-{rnd.randrange(1000, 9999)} and 10.{rnd.randrange(256)}.3.{rnd.randrange(300)}") for i in range(300)]
    pair = "7536784127813050 4845168114407329"
    rows += [(900, f"see {pair} there"), (901, "é " + " ".join(card() for _ in range(9)) + " end")]
    found = {r["doc_id"]: r["spans"].split(",") for r in _pii(spark, rows)}
    assert {"card:4:20", "card:21:37"} <= set(found[900])
    assert {f"card:{2 + 17 * k}:{18 + 17 * k}" for k in range(9)} <= set(found[901])
    masked = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows)).collect()}
    assert masked[900].replace("*", "").split() == ["see", "there"]
