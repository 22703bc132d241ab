"""Document counts and host verdicts against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import quality_rules as rules
from ledgerline.llm.common import documents

GAP = re.compile("[ \t-\r]+")


def counts(text):
    text = text or ""
    words = [w for w in GAP.split(text) if w]
    lines = [s for s in text.split("\n") if GAP.sub("", s)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def brute_force(rows):
    """doc_id -> the five counts, base_failed, kept; rows are (doc_id, text, host)."""
    own, hosts = {}, defaultdict(list)
    for doc, text, host in rows:
        n, chars, symbols, dup, repeat = found = counts(text)
        base = n < 50 or 100 * repeat > 50 * n
        fails = base or symbols > 0.3 * n or dup > 0.1 * n or chars < 2.5 * n or chars > 15 * n
        own[doc] = (*found, base, host)
        if host is not None:
            hosts[host].append(fails)
    rates = [sum(f) / len(f) for f in hosts.values()]
    mean = sum(rates) / len(rates) if rates else 0
    spread = mean * (1 - mean)
    noise = sum(1 / len(f) for f in hosts.values()) / len(rates) if rates else 0
    own_variance = max(sum((r - mean) ** 2 for r in rates) / len(rates) - spread * noise, 0) if rates else 0
    weight = 1e6 if own_variance == 0 else min(max(spread / own_variance - 1, 2), 1e6)
    bad = {h for h, f in hosts.items() if (sum(f) + mean * weight) / (len(f) + weight) > 0.5}
    return {d: (*r[:6], not r[5] and r[6] not in bad) for d, r in own.items()}


def answer(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_given_documents(spark, folder):
    docs = documents(spark, folder)
    assert answer(rules.report(docs)) == brute_force([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])


def test_bad_hosts_take_their_documents_with_them(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", f"h{i % 7}") for i in range(140)]
    rows += [(1000 + i, good + f" {i}" if i < 4 else "#### " * 80, "spam") for i in range(60)]
    rows += [(2000, good, "tiny"), (2001, "too short", "tiny"), (2002, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = answer(rules.report(docs))
    assert got == brute_force(rows)
    assert not got[1000][-1] and got[2000][-1] and got[2002][-1]


def test_odd_rows(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a b c a b c", "a a a a", "x y\n\nx y\n x y", "\xa0 nbsp joins", "$ # & é𝒳", "w " * 200_000, "w1 w2\n" * 30]
    rows = [(i, t, None if i % 2 else "h") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "7 AS n_words", "'x' AS kept")
    assert answer(rules.report(docs)) == brute_force(rows)
    judged = rules.judge(docs)
    assert judged.columns.count("n_words") == 1 and judged.count() == len(rows)
    assert rules.report(docs.limit(0)).collect() == []
    twice = rules.report(docs.union(docs)).collect()
    assert len(twice) == 2 * len(rows)


@pytest.mark.parametrize("mean, expected", [(0.0, 0.0), (0.5, 0.25)])
def test_spread(mean, expected):
    assert rules.mean_spread(mean) == expected
