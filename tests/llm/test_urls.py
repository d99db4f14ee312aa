"""URL rules against a plain search, the regression against numpy."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripleframe.llm import urls
from tripleframe.llm.queries import URL_RULES

ODD = [
    None, "", "no scheme", "http://", "http://A.Example.ORG", "https://a.org/", "x://a.org?q=/", "x://notorg/fr/", "http://example.org/es/1", "http://m.example.org/es",
    "http://badexample.org/es/9", "http://example.org/en/12?x#y", "http://example.org/en/2", "ftp://B.COM/de/1", "http://com/fr/", "http://a.com:80/fr/", "http://u@a.com/fr/x",
    "http://É.net/ü\n/b", "a://b://c.org/d", "http://casino-win.example.net/en/1", "http://😀.net/" + "long" * 5000, "http://org#x",
]


def cut(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda m: m.group().lower(), found[1]), found[2]) if found else ("", "")


def terms(url):
    whole = "".join(cut(url))
    grams = {whole[i : i + n] for n in urls.SIZES for i in range(len(whole) - n + 1)}
    return sorted({int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % urls.BUCKETS for g in grams} | {urls.BUCKETS})


def dense(found):
    x = np.zeros((len(found), urls.BUCKETS + 1))
    for i, url in enumerate(found):
        t = terms(url)
        x[i, t] = 1 / np.sqrt(len(t))
    return x


@pytest.fixture(scope="module")
def weights(spark):
    return urls.fit(urls.labelled_urls(spark))


def test_training_is_gradient_descent(spark, weights):
    rows = urls.labelled_urls(spark).collect()
    assert len(rows) < urls.MOST and len({r["url"] for r in rows}) == len(rows)
    x, y, w = dense([r["url"] for r in rows]), np.array([r["blocked"] for r in rows]), np.zeros(urls.BUCKETS + 1)
    for _ in range(urls.STEPS):
        w = w * (1 - urls.RATE * urls.DECAY) - urls.RATE / len(rows) * x.T @ (1 / (1 + np.exp(-x @ w)) - y)
    assert np.allclose(w, weights, atol=1e-9)
    assert ((x @ w > 0) == y).mean() > 0.99


def test_held_out_urls(spark):
    rows = urls.labelled_urls(spark).withColumn("part", F.crc32(F.col("url").cast("binary")) % 5)
    weights = np.array(urls.fit(rows.where("part <> 0")))
    held = rows.where("part = 0").collect()
    said, y = dense([r["url"] for r in held]) @ weights > 0, np.array([r["blocked"] for r in held]) == 1
    assert (said == y).mean() > 0.9 and said[y].mean() > 0.75


def test_rules_and_odd_urls(spark, weights):
    df = spark.createDataFrame([(i, u, "r", 1) for i, u in enumerate(ODD)], "page_id long, url string, rule string, blocked int")
    got = {r["page_id"]: r for r in urls.judge(df, weights, URL_RULES).collect()}
    assert len(got) == len(ODD)
    logits = dense(ODD) @ np.array(weights)
    for i, url in enumerate(ODD):
        host, path = cut(url)
        fit = [r for r in URL_RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        rule = max(fit, key=lambda r: len(r.host + r.path), default=None)
        row = got[i]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule.host + rule.path), url
        assert abs(row["logit"] - logits[i]) < 1e-9
        assert row["verdict"] == (rule.verdict if rule else "block" if logits[i] > 0 else "allow")


def test_empty_tables(spark, weights):
    none = spark.createDataFrame([], "url string, blocked int")
    assert urls.judge(none, weights, URL_RULES).count() == 0
    for rows in ([], [(None, None)], [("http://a.net", None)]):
        assert set(urls.fit(spark.createDataFrame(rows, "url string, blocked int"), steps=3)) == {0.0}
    assert len(urls.fit(spark.createDataFrame([(None, 1), ("", 0), ("", 0)], "url string, blocked int"), steps=3)) == urls.BUCKETS + 1
