"""URL filter, language ID, toxicity and quality: hand-made cases, brute force and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.llm import _learn, _scan, language_id, quality, toxicity, url_filter
from waymark.llm._spark import held_out, ship

# --- urls ------------------------------------------------------------------------

URLS = [
    None, "", "nothing", "http://A.net/x", "http://a.NET", "https://net/", "http://x.example.net/en/1", "http://example.net/en", "http://www.example.com/de/1?x=://y", "http://badexample.com/de/1",
    "ftp://a.org/fr/#x", "a://b://c/d", "http://ÄB.org/fr/x\ny", "http://h.org?q=/fr/", "//x.net/", "http:///de/", "http://user@example.com:80/de/", "http://c.example.com/de/x#/y",
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_urls_against_brute_force(spark):
    df = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, path string, n int")
    got = {r.id: r for r in url_filter.url_filter(df).collect()}
    for i, u in enumerate(URLS):
        host, path = parse(u)
        r = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, r and r.text)
        assert got[i].verdict == (r.verdict if r else "allow")
    assert url_filter.url_filter(df.limit(0)).count() == 0


def test_templates_reject_what_labels_condemn(spark):
    rows = [f"http://spam.org/offer/{i}.html" for i in range(40)] + [f"http://spam.org/news/{i}" for i in range(40)] + [f"http://spam.org/{w}/deal" for w in map("w{}x".format, range(60))]
    df = spark.createDataFrame([(i, u, (1 if "offer" in u else 0 if "news" in u else 1) if i % 3 == 0 else None) for i, u in enumerate(rows)], "page_id int, url string, bad int")
    got = {r.id: r for r in url_filter.url_filter(df, label_col="bad").collect()}
    assert {got[i].verdict for i in range(40)} == {"block"} and {got[i].verdict for i in range(40, 80)} == {"allow"}
    assert got[1].template == "/offer/{num}.html" and got[100].template == "/*/deal" and got[100].verdict == "block"
    assert len(got) == len(rows)


def test_unlabelled_siblings_of_a_blocked_branch_stay(spark):
    rows = [f"http://a.example.com/{lang}/{i}" for lang in ("de", "fr", "en") for i in range(30)]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id int, url string")
    got = {r.path.split("/")[1]: r.verdict for r in url_filter.url_filter(df).collect()}
    assert got == {"de": "block", "fr": "allow", "en": "allow"}


def literal_tree(paths, min_fan, rare, rare_share, merge_z, prior, weight):
    """{raw: (template, purity, labels)} of one host's {raw: (n, bad, good)}, one node after the other."""
    template = {}

    def grow(at, rows):
        for raw in [r for r in rows if not rows[r]]:
            template[raw] = at
        rows = {r: rest for r, rest in rows.items() if rest}
        if len(rows) < min_fan:
            template.update({r: (*at, *rest) for r, rest in rows.items()})
            return
        times = {}
        for r, rest in rows.items():
            times[rest[0]] = times.get(rest[0], 0) + paths[r][0]
        few = {s for s, n in times.items() if n <= max(rare, sum(times.values()) * rare_share)}
        few = few if len(few) >= min_fan else set()
        for step in {"*" if s in few else s for s in times}:
            grow((*at, step), {r: rest[1:] for r, rest in rows.items() if ("*" if rest[0] in few else rest[0]) == step})

    grow((), {r: r for r in paths})
    was = dict(template)
    sums = lambda of: {t: tuple(sum(paths[r][k] for r in paths if of[r] == t) for k in (1, 2)) for t in set(of.values())}
    for d in range(max(map(len, template.values()), default=0) - 1, -1, -1):
        groups = {}
        for t, (b, g) in sums(template).items():
            if len(t) > d and b + g and not t[d].startswith("{") and t[d] != "*":
                groups.setdefault((t[:d], t[d + 1 :]), []).append((t, b, b + g))
        for (left, right), stat in groups.items():
            if len(stat) < 2:
                continue
            pool = (sum(b for _, b, _ in stat) + 0.5) / (sum(m for *_, m in stat) + 1)
            alike = {t for t, b, m in stat if abs((b + 0.5) / (m + 1) - pool) <= merge_z * (pool * (1 - pool) / m) ** 0.5}
            if len(alike) > 1:
                template = {r: (*left, "{~}", *right) if t in alike else t for r, t in template.items()}
    own = sums(template)
    branch = {}
    for r, t in template.items():
        for d in range(1, len(t) + 1):
            b, m, names = branch.get(t[:d], (0, 0, frozenset()))
            _, bad, good = paths[r]
            branch[t[:d]] = (b + bad, m + bad + good, names | ({was[r][d - 1]} if bad + good else set()))

    def told(prefix):
        below = [v for k, v in branch.items() if k[:-1] == prefix and v[1]]
        up, more = told(prefix[:-1]) if prefix else (prior, 0)
        return (sum(len(w) * (b + prior * weight) / (m + weight) for b, m, w in below) + weight * up) / (sum(len(w) for *_, w in below) + weight), sum(m for _, m, _ in below) or more

    out = {}
    for r, t in template.items():
        (b, g), (p, labels) = own[t], told(t[:-1])
        out[r] = (t, (b + weight * p) / (b + g + weight), b + g or labels)
    return out


def test_template_tree_against_a_literal_one(spark):
    r = random.Random(8)
    how = {"min_fan": 4, "rare": 2, "rare_share": 0.02, "merge_z": 2.0, "prior": 0.5, "weight": 2.0}
    urls = []
    for h in range(12):
        bad = {w: r.random() for w in "abcdefgh"}
        for _ in range(r.randint(1, 160)):
            deep = [r.choice(["shop", "blog", "x"]) for _ in range(r.choice([0, 0, 1, 3]))] + [r.choice("abcdefgh" if h % 2 else "ab")]
            deep += [r.choice([f"w{r.randrange(60)}", "about", str(r.randrange(99)), f"{r.randrange(9)}.html"]) for _ in range(r.choice([0, 1, 1, 2, 6]))]
            deep = deep[: r.randint(0, 9)]
            word = next((s for s in deep if s in bad), None)
            label = int(r.random() < round(bad[word])) if word and r.random() < 0.4 else None
            urls.append((h, deep, label))
    rows = [(i, f"http://h{h}.test/{'/'.join(deep)}", label) for i, (h, deep, label) in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id int, url string, bad int")
    got = {x.id: x for x in url_filter.url_filter(df, rules=(), label_col="bad", salt=3, min_labels=5, **how).collect()}
    shape = lambda s: "{num}" if s.isdigit() else "{num}.html" if s.endswith(".html") and s[:-5].isdigit() else s
    verdicts = set()
    for h in range(12):
        paths = {}
        for g, deep, label in urls:
            if g == h:
                was = paths.get(raw := tuple(map(shape, deep)), (0, 0, 0))
                paths[raw] = (was[0] + 1, was[1] + (label == 1), was[2] + (label == 0))
        want = literal_tree(paths, **how)
        for i, (g, deep, _) in enumerate(urls):
            if g == h:
                t, share, labels = want[tuple(map(shape, deep))]
                assert got[i].template == "".join("/" + x for x in t) and got[i].blocked_share == pytest.approx(share, abs=1e-9) and got[i].labels == labels
                assert got[i].verdict == ("block" if share >= 0.8 and labels >= 5 else "allow")
                verdicts.add(("{~}" in t, "*" in t, got[i].verdict))
    assert {v for *_, v in verdicts} == {"allow", "block"} and {m for m, *_ in verdicts} == {w for _, w, _ in verdicts} == {True, False}


def test_many_blocked_siblings_condemn_an_unlabelled_one(spark):
    rows = [f"http://a.test/{w}/{i}" for w in "pqrstu" for i in range(12)] + [f"http://a.test/new/{i}" for i in range(5)] + [f"http://b.test/{w}/{i}" for w in ("p", "new") for i in range(12)]
    df = spark.createDataFrame([(i, u, None if "new" in u else 1) for i, u in enumerate(rows)], "page_id int, url string, bad int")
    got = {(r.host, r.path.split("/")[1]): r.verdict for r in url_filter.url_filter(df, rules=(), label_col="bad").collect()}
    assert got["a.test", "new"] == "block" and got["b.test", "new"] == "allow" and got["b.test", "p"] == "block"


def test_registered_urls_without_a_rule_are_judged_by_evidence(spark, sf_dir):
    """The tree says more of them than its prior: above it where a branch of the host is blocked, below where one is allowed."""
    from waymark.llm.queries import QUERIES

    got = [r for r in QUERIES["op7_url_filter"](spark, sf_dir).collect() if r.rule is None and r.labels]
    assert got and all(r.blocked_share > 0.5 for r in got if r.host.endswith("com")) and all(r.blocked_share < 0.5 for r in got if r.host.endswith("org"))


# --- languages -----------------------------------------------------------------------

WORDS = {"aa": ["tion", "the", "ing", "with"], "bb": ["schön", "über", "nicht", "gebe"], "cc": ["oui", "été", "eaux", "très"]}


def speech(seed, n=240):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        out.append((i, " ".join(r.choice(WORDS[lang]) + r.choice(["", r.choice(WORDS[lang])]) for _ in range(r.randint(2, 40))), lang))
    return out


def test_grams_by_brute_force():
    texts = ["Ab1É", "", "ñ  x", "aß"]
    c = next(_scan.chunks(pa.array(texts)))
    got = language_id.gram_counts(c, 64).sum(1).tolist()

    def count(t):
        b = [language_id.LETTERS[x] for x in t.lower().encode()]
        one = sum(x > 0 for x in b)
        two = sum(b[i] > 0 or b[i + 1] > 0 for i in range(len(b) - 1))
        return one + two + sum(b[i + 1] > 0 for i in range(len(b) - 2))

    assert got == [count(t) for t in texts]


def test_languages_held_out(spark):
    ship(spark)
    rows = [*((i, t, lang, 1) for i, t, lang in speech(3)), (1000, None, "aa", 1), (1001, "", "aa", 1), (1002, "12 !?", "bb", 1), (1003, "x" * 300_000, None, 1), (1004, "語", "cc", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = language_id.fit(df, ~held_out())
    got = {r.id: r for r in language_id.predict(df, model).collect()}
    out = [i for i, *_ in rows[:240] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i].lang_pred == rows[i][2] for i in out]) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002)) and got[1003].lang_pred in WORDS and got[1004].lang_pred in WORDS
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1003].rejected
    assert language_id.predict(df.limit(0), model).count() == 0
    assert {r.lang_pred for r in language_id.predict(df, language_id.fit(df.where("false"), ~held_out())).collect()} == {"und"}


def test_short_and_empty_texts_stay_within_bounds():
    """Chunks are bounded in rows too, so that counts of many short texts take little memory."""
    import tracemalloc

    spark_free = language_id._predict(language_id.Model(["aa"], np.ones((1, 4096), np.float32) / 64, np.zeros(1, int), np.zeros(1), np.ones(4096)), 4096)
    for text in ("", "wort"):
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.array([text] * 10_000)], names=["id", "text"])
        tracemalloc.start()
        assert sum(b.num_rows for b in spark_free(iter([batch]))) == 10_000
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 << 20


def test_int_ids_and_too_many_languages(spark):
    ship(spark)
    df = spark.createDataFrame([(i, t, lang) for i, t, lang in speech(4, 60)], "doc_id int, text string, lang string")
    got = language_id.predict(df, language_id.fit(df, ~held_out()))
    assert dict(got.dtypes)["id"] == "bigint" and got.count() == 60
    with pytest.raises(ValueError):
        language_id.fit(df.withColumn("lang", F.col("doc_id").cast("string")), F.lit(True), most_languages=20)


# --- classifiers ---------------------------------------------------------------------------


def labelled(seed, n=600):
    r = random.Random(seed)
    rows, toxic, good = [], [], []
    for i in range(n):
        w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(r.randint(5, 60))]
        q = int(r.random() < 0.7)
        t = int(r.random() < 0.15)
        if t:
            for _ in range(r.randint(1, 4)):
                w.insert(r.randrange(len(w)), r.choice(["idiot", "Stupid", "you moron", "worthless,", "1diot"]))
        text = " ".join(w).capitalize() + "."
        rows.append((i, text if q else r.choice([text.upper(), text.replace(" ", " | "), (w[0] + " ") * 40]), "x", 1.0))
        toxic.append(t)
        good.append(q)
    return rows, toxic, good


@pytest.fixture(scope="module")
def corpus(spark):
    ship(spark)
    rows, toxic, good = labelled(1)
    rows += [(9000, None, "x", 1.0), (9001, "", "x", 1.0), (9002, "idiot " * 50_000, "x", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, score double").repartition(3)
    labels = spark.createDataFrame([(i, good[i], toxic[i]) for i in range(len(toxic)) if i % 9] + [(3, None, None), (None, 1, 1), (77777, 1, 1)], "doc_id long, quality int, toxic int")
    return df, labels, toxic, good


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_held_out_accuracy(corpus, which):
    df, labels, toxic, good = corpus
    out = toxicity.toxicity(df, labels) if which == "toxic" else quality.quality(df, labels)
    got = {r.id: r for r in out.collect()}
    truth = toxic if which == "toxic" else good
    held = [i for i in range(len(truth)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i in held) and sum(r.held_out for r in got.values()) < len(got) / 3
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.93
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(truth) + 3
    limit = 0.3 if which == "toxic" else 0.7
    assert all(r.predicted == int(r.score >= limit) for r in got.values())
    if which == "toxic":
        assert got[9002].predicted == 1 and got[9000].predicted == 0


def test_held_out_labels_dont_matter(corpus):
    df, labels, *_ = corpus
    flipped = labels.withColumns({c: F.when(held_out(), 1 - F.col(c)).otherwise(F.col(c)) for c in ("toxic", "quality")})
    for f in (toxicity.toxicity, quality.quality):
        assert sorted(map(tuple, f(df, labels).collect())) == sorted(map(tuple, f(df, flipped).collect()))


def test_without_labels_or_rows(corpus):
    df, labels, *_ = corpus
    for f in (toxicity.toxicity, quality.quality):
        assert f(df, labels.limit(0)).count() == df.count() and f(df.limit(0), labels).count() == 0
    assert toxicity.toxicity(df, labels.limit(0)).where("predicted = 1").count() == 0
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()


def test_toxic_features():
    c = next(_scan.chunks(pa.array(["You idiot! you IDIOT", "1d1ot id.iot", "fine words here", "", None, "idiot far a b c d e f g h you"])))
    x = dict(zip(toxicity.NAMES, toxicity._Measure(toxicity.LEXICON)(c).T, strict=True))
    assert x["lexicon_density"].tolist()[:4] == [0.5, 0, 0, 0] and x["near_second_person"].tolist() == [1, 0, 0, 0, 0, 0]
    assert x["log_obfuscated"][1] == pytest.approx(np.log(3)) and x["mixed_words"][1] == 1 and x["shouted_words"][0] == 0.25 and np.isfinite(np.stack(list(x.values()))).all()


def test_isotonic_is_monotone():
    r = np.random.default_rng(0)
    s = r.normal(size=500)
    at, share = toxicity.isotonic(s, (r.random(500) < 1 / (1 + np.exp(-3 * s))).astype(int))
    assert (np.diff(share) >= 0).all() and (np.diff(at) > 0).all()


def test_discriminant_by_direct_densities():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(size=(200, 3)) * 2 + 1, r.normal(size=(300, 3))])
    y = np.repeat([0, 1], [200, 300])
    m = quality.fit(x, y, pooled=0.0, ridge=0.0, temper=1.0)
    z = (x - m.centre) / m.scale

    def density(k):
        s = z[y == k]
        d = z - s.mean(0)
        cov = np.cov(s, rowvar=False, bias=True)
        return np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d @ np.linalg.inv(cov) * d).sum(1)

    assert m(x) == pytest.approx(1 / (1 + np.exp(density(0) - density(1))), abs=1e-9)


def test_quality_of_few_labels():
    x = np.random.default_rng(4).normal(0, 1, (12, 14))
    y = np.arange(12) % 4 == 0  # three of one label, then one
    x[y] += 0.7
    for own in (y, y & (np.arange(12) == 4)):
        score = quality.fit(x, own.astype(int))(x)
        assert len(set(score)) > 6 and score[own].min() > score[~y].max()
    assert len(set(quality.fit(x, np.zeros(12, int))(x))) == 1


def test_quality_statistics_are_finite():
    c = next(_scan.chunks(pa.array(["", None, "a", "A B\nA B\n", "é" * 9, "x " * 999])))
    assert np.isfinite(quality.measure(c)).all()


def test_samples_are_bounded(spark, corpus):
    df, labels, *_ = corpus
    rows = _learn.feature_rows(df, quality.measure, "doc_id", "text")
    x, y, ids = _learn.labelled_sample(rows, labels, "quality", sample=100)
    assert 50 < len(y) < 160 and x.shape == (len(y), len(quality.NAMES)) and (np.diff(ids) > 0).all()


def test_toxic_words_are_learned_and_no_column_but_the_text_counts(spark):
    """No language is an input of a score, so words are learned whatever the column says."""
    r = random.Random(5)
    rows, labels = [], []
    for i in range(1600):
        lang, t = r.choice(["aa", "bb"]), int(r.random() < 0.15)
        w = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(r.randint(5, 60))]
        for _ in range(r.randint(3, 5) if t else 0):
            w.insert(r.randrange(len(w)), ("zorku" if lang == "aa" else "quilm") + r.choice(["a", "eb", "ich", "od", "uff"]))
        rows.append((i, " ".join(w), lang))
        labels.append((i, t))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {x.id: x for x in toxicity.toxicity(df, known).where("held_out").collect()}
    for lang in ("aa", "bb"):
        bad = [got[i].predicted for i, t in labels if t and i in got and rows[i][2] == lang]
        good = [got[i].predicted for i, t in labels if not t and i in got and rows[i][2] == lang]
        assert len(bad) > 10 and np.mean(bad) > 0.9 and np.mean(good) < 0.03
    other = toxicity.toxicity(df.withColumn("lang", F.lit("cc")), known).where("held_out").collect()
    assert sorted(map(tuple, got.values())) == sorted(map(tuple, other))


def test_one_boosting_step_by_brute_force():
    """A tree of one split takes the cut of the largest gain, and its leaves are the second-order steps."""
    r = np.random.default_rng(3)
    x = r.integers(0, 12, size=(300, 4)).astype(float)
    y = (r.random(300) < 1 / (1 + np.exp(-(x[:, 2] - 6)))).astype(float)
    model = toxicity.boost(x, y, trees=1, depth=1, rate=0.5, l2=3.0, least=10)
    share = (y.sum() + 1) / (len(y) + 2)
    base = np.log(share / (1 - share))
    g, h = share - y, np.full(len(y), share * (1 - share))

    def gain(left):
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 3.0)
        return part(left) + part(~left) if min(left.sum(), (~left).sum()) >= 10 else -1

    left = max((x[:, j] <= v for j in range(4) for v in range(12)), key=gain)
    step = lambda m: -0.5 * g[m].sum() / (h[m].sum() + 3.0)
    assert model.margin(x) == pytest.approx(base + np.where(left, step(left), step(~left)), abs=1e-9)


def test_isotonic_by_brute_force():
    """Without a least size the blocks are those of max over starts of min over ends of means."""
    r = np.random.default_rng(4)
    s = np.sort(r.normal(size=60))
    y = (r.random(60) < 1 / (1 + np.exp(-2 * s))).astype(float)
    want = [max(min(y[j : k + 1].mean() for k in range(i, 60)) for j in range(i + 1)) for i in range(60)]
    at, share = toxicity.isotonic(s, y, least=1)
    assert np.unique(np.round(want, 12)).tolist() == np.unique(np.round(share, 12)).tolist()
    assert at.tolist() == pytest.approx([s[np.isclose(want, v)].mean() for v in np.unique(np.round(want, 12))])


def test_few_labels_still_teach(spark):
    """No number of labels switches the trees off; labels of one kind give their smoothed share."""
    rows = [(i, " ".join(["plain words here" if i % 2 else "you idiot moron scum", *("".join(chr(97 + (i * j) % 26) for j in range(i % 7 + 2)) for _ in range(i % 9))]), i % 2 == 0) for i in range(48)]
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    few = spark.createDataFrame([(i, int(b)) for i, _, b in rows][:36], "doc_id long, toxic int")
    got = {r.id: r.predicted for r in toxicity.toxicity(df, few).collect()}
    assert np.mean([got[i] == int(b) for i, _, b in rows]) > 0.9
    same = toxicity.toxicity(df, few.withColumn("toxic", F.lit(1))).collect()
    known = len({t for i, t, _ in rows[:36] if zlib.crc32(str(i).encode()) % 4 != 2})  # copies count once
    assert {round(r.score, 9) for r in same} == {round((known + 0.5) / (known + 10), 9)}
