"""Language, quality, URL rules, licenses: brute force, held-out accuracy and odd rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from hearthline.llm import langid, license_scan, quality, queries, url_filter
from tests.llm.conftest import plain, prose

TABLES = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    got = queries.op7_language(spark, TABLES)
    truth = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def brute_bayes(rows, texts, settings):
    """Multinomial naive Bayes over plain n-gram strings; the buckets are wide enough not to clash."""
    fold = lambda t: re.sub(rb"[^a-z\x80-\xff]", b" ", t.encode().lower())
    grams = lambda t: [fold(t)[i : i + n] for n in settings.sizes for i in range(len(fold(t)) - n + 1) if fold(t)[i : i + n].strip()]
    counts: dict[str, dict] = {}
    for text, lang in rows:
        for g in grams(text):
            own = counts.setdefault(lang, {})
            own[g] = own.get(g, 0) + 1
    out = []
    for t in texts:
        score = {
            lang: sum(np.log((c.get(g, 0) + settings.smoothing) / (sum(c.values()) + settings.smoothing * settings.buckets)) for g in grams(t))
            for lang, c in counts.items()
        }
        out.append(max(sorted(score), key=lambda k: score[k]))
    return out


def test_language_is_naive_bayes(frame):
    settings = langid.Settings(sizes=(1, 2), buckets=1 << 20)
    known = [("aa ab ba", "x"), ("cc cd DC 12", "y"), ("ab cd", "x"), (None, "x"), ("zz", None), ("éé è", "z")]
    model = langid.fit(frame([(i, *r) for i, r in enumerate(known)], "id int, text string, lang string"), settings=settings)
    assert model.languages == ["x", "y", "z"]
    texts = ["ab", "dc!", "cc aa ab", "è", "Ab-cD"]
    docs = frame([(t, 0.5) for t in texts + [None, "", "12 !?", "٣"]], "text string, score double")
    got = {r.text: r for r in langid.identify(docs, model, keep=["text", "score"]).collect()}
    want = brute_bayes([(t, lang) for t, lang in known if t and lang], texts, settings)
    assert [got[t].lang_pred for t in texts] == want
    assert all((got[t].lang_pred, got[t].score) == ("und", 0.0) for t in (None, "", "12 !?", "٣"))


def test_language_without_rows(frame):
    empty = frame([], "text string, lang string")
    model = langid.fit(empty)
    assert langid.identify(empty, model).collect() == []
    assert langid.identify(frame([("abc",)], "text string"), model, keep=[]).collect()[0].lang_pred == "und"
    with pytest.raises(ValueError, match="more than 1 languages"):
        langid.fit(frame([("a", "x"), ("b", "y")], "text string, lang string"), settings=langid.Settings(max_languages=1))


def test_quality_of_held_out_rows(spark):
    got = queries.op1_quality(spark, TABLES)
    rows = got.join(spark.read.parquet(f"{TABLES}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert got.count() == 1000 and np.mean([r.predicted == 1 for r in good]) > 0.95
    assert np.mean([r.predicted == 0 for r in bad]) > 0.9
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_quality_risk_is_not_negative():
    r = np.random.default_rng(0)
    positive = r.normal(1, 1, (300, 4)).astype(np.float32)
    mixed = np.concatenate([r.normal(1, 1, (700, 4)), r.normal(-1, 1, (300, 4))]).astype(np.float32)
    settings = quality.Settings(steps=200)
    model = quality.fit_pu(positive, mixed, 0.7, settings)
    scores = model.score(mixed)
    assert (scores[:700] > 0.5).mean() > 0.9 and (scores[700:] < 0.5).mean() > 0.85
    assert np.array_equal(scores, quality.fit_pu(positive, mixed, 0.7, settings).score(mixed))


def test_quality_of_odd_rows(frame):
    from pyspark.sql import functions as F

    docs = frame([(i, "word " * (i + 3), 7) for i in range(6)] + [(6, None, 7), (None, "", 7)], "doc_id long, text string, score int")
    labels = frame([(0, 1), (1, 1), (1, 0), (None, 1), (2, None), (0, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels, F.lit(True))
    rows = quality.score(docs, model, keep=["doc_id", "score"]).collect()
    assert model.prior == (1 + 1) / (2 + 2) and len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    none = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(docs, none, keep=["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.limit(0), none).collect() == []


def naive_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c < "\x7f" else c for c in host)
    fits = [h + p for h, p, _ in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len) if fits else None


def test_url_rules_agree_with_brute_force(frame):
    r = random.Random(1)
    hosts = ["example.org", "org", "a.com", "b.a.com", "é.org", "forg", "com.org", ""]
    paths = ["", "/", "/es/", "/en/1", "/fr/x", "/de", "/de/x.org/y", "/../org/"]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("a.com", "", "block"), ("é.org", "/en", "block")]
    rules += [(f"h{i}.net", f"/{'p' * (i % 9)}", "block") for i in range(60)]  # several words of bits
    urls = [None, "", "org/", "http:/org/", "://org/", "HTTP://WWW.Example.ORG/es/?q#f", "http://org#/", "x://y://org/"]
    urls += [f"http://{r.choice(['', 'www.', 'A.'])}{r.choice(hosts + ['h7.net', 'h59.net'])}{r.choice(paths)}{r.choice(['', 'pppppp', '?a=/b', '#c'])}" for _ in range(400)]
    pages = frame([(i, u, "host") for i, u in enumerate(urls)], "page_id int, url string, host string")
    got = url_filter.judge(pages, [url_filter.host_rule(*x) for x in rules]).orderBy("page_id").collect()
    want = [naive_rule(u, rules) for u in urls]
    assert [(x.host, x.path, x.rule) for x in got] == want
    verdict = {h + p: v for h, p, v in rules}
    assert all(x.verdict == (verdict.get(x.rule) or ("allow" if x.host else "block")) for x in got)


def test_url_globs_and_empty_inputs(frame):
    rules = [url_filter.Rule("ads", "block", ("*#*/ads/*", "*#*.ads.*.gif"))]
    pages = frame([("http://x.y/a/ads/1",), ("http://x.y/b.ads.c.gif",), ("http://x.y/ad",)], "url string")
    assert [r.rule for r in url_filter.judge(pages, rules, keep=["url"]).collect()] == ["ads", "ads", None]
    assert [r.verdict for r in url_filter.judge(pages, [], keep=[]).collect()] == ["allow"] * 3
    assert url_filter.judge(pages.limit(0), rules).collect() == []


def test_license_places_and_spans(frame):
    r = random.Random(2)
    notice = license_scan.TEMPLATES[1][1]
    changed = notice.split()
    changed[5] = "anybody"
    del changed[12]
    texts = [
        None, "", "...", "MIT License", "the mit\nlicense, the MIT license; GNU General-Public License!", "apache licenses", "license",
        f"{prose(r, 50)} {notice} {prose(r, 20)}", f"{prose(r, 9)} {' '.join(changed)}", "Licensed under CC BY-NC 4.0",
        " ".join(notice.split()[:6]), "éMIT license mit license" + " x" * 40_000,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, texts[4]), (None, "MIT License")]
    docs = frame([(*x, "labels") for x in rows], "doc_id long, text string, labels string")
    got = license_scan.scan(docs).collect()
    assert len(got) == len(rows)
    for x in got:
        words = plain(texts[x.id] if x.id is not None else "MIT License")
        places = [
            (i, v) for p, v in license_scan.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()
        ]
        assert (x.n_words, x.n_base) == (len(words), len(places))
        assert x.base_labels == ",".join(sorted({v for _, v in places}))
        assert (x.first_word, x.last_word) == ((min(places)[0], max(p for p, _ in places)) if places else (None, None))
        assert set(x.base_labels.split(",")) <= set(x.labels.split(",")) or not x.base_labels
    labels = {x.id: x.labels for x in got}
    assert labels[7] == labels[8] == "mit" and labels[9] == "cc-by-nc" and labels[10] == "" and labels[5] == ""
    assert {x.id: x.score for x in got}[2] == 0.0 and license_scan.scan(docs.limit(0)).collect() == []


def test_license_scan_beyond_the_broadcast_bound(frame):
    docs = frame([(1, "Released under the MIT License.")], "doc_id int, text string")
    settings = license_scan.Settings(broadcast_rows=0)
    assert [x.labels for x in license_scan.scan(docs, settings=settings).collect()] == ["mit"]


def brute_spans(text, settings):
    """Labels and best coverage by plain loops over all places and templates."""
    words, k, found = plain(text), settings.k, []
    for label, template in license_scan.TEMPLATES:
        t = plain(template)
        votes = sorted(
            (i - j, i, j) for i in range(len(words) - k + 1) for j in range(len(t) - k + 1) if words[i : i + k] == t[j : j + k]
        )
        runs = []
        for vote in votes:
            if not runs or vote[0] - runs[-1][-1][0] > settings.slack:
                runs.append([])
            runs[-1].append(vote)
        for run in runs:
            covered = len({j for _, _, j in run}) / (len(t) - k + 1)
            length = max(i for _, i, _ in run) + k - min(i for _, i, _ in run)
            if covered >= settings.coverage and length <= settings.stretch * len(t):
                found.append((label, covered))
    return {label for label, _ in found}, max((c for _, c in found), default=0.0)


def test_license_spans_agree_with_brute_force(frame):
    r, settings, texts = random.Random(7), license_scan.Settings(), []
    for i in range(80):
        words = prose(r, r.randrange(30), 30).split()
        for _ in range(r.randrange(4)):
            notice = plain(r.choice(license_scan.TEMPLATES)[1])
            for _ in range(r.randrange(5)):
                at = r.randrange(len(notice))
                notice = r.choice([notice[:at] + notice[at + 1 :], notice[:at] + ["new"] + notice[at:], notice[:at]]) or notice
            words += notice + prose(r, r.randrange(9), 30).split()
        texts.append(" ".join(words))
    got = license_scan.scan(frame(list(enumerate(texts)), "doc_id int, text string")).collect()
    for x in got:
        labels, score = brute_spans(texts[x.id], settings)
        base = set(filter(None, x.base_labels.split(",")))
        assert x.labels == ",".join(sorted(labels | base))
        assert x.score == pytest.approx(1.0 if base else score)
