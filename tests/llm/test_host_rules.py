import random
import re
from collections import Counter

import pytest

from checks.compare import difference
from tablewright.llm import ORACLES
from tablewright.llm.host_rules import COUNTS, HostRules, _beta_prior, host_quality, host_verdicts, op3_host_rules, repeated_words, text_counts
from tests.llm.conftest import text_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            again, lines = again + (line in seen), lines + 1
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), lines)


@pytest.mark.parametrize("text", [
    "", " ", "a", "a b c a b c", "a a a a a", "x y z\nx y z\n\n\x0bx y z", "é ü ß ☃\r\n$5 & <b>|", "a b " * 200 + "c d e f g",
    " ".join(str(i * i % 97) for i in range(500))])
def test_counts(text):
    assert text_counts(text.encode(), len(text)) == by_hand(text)


def test_windows_of_many_kinds_of_words():
    words = [str(i).encode() for i in range(3000)] * 2
    assert repeated_words(words, 6) == 6000


def test_bad_hosts_take_their_documents_along(spark):
    fine = " ".join(f"w{i}" for i in range(80))
    texts, sources = [], []
    for h in range(40):  # a sixth of the documents of most hosts fails, of the bad ones two fifths, of a small one all
        for i in range(120):
            texts.append("short" if i % 6 == 0 or (h < 2 and i % 5 < 2) else f"{fine} {h} {i}")
            sources.append(f"bad{h}" if h < 2 else f"host{h}")
    texts += ["short"] * 3 + [fine + " $" * 40]
    sources += ["tiny"] * 4
    rows = host_quality(text_table(spark, texts, sources)).collect()
    assert {r.source for r in rows if not r.host_kept} == {"bad0", "bad1"}
    assert all(r.kept == (not r.source.startswith("bad") and not r.base_failed) for r in rows)
    assert {r.base_failed for r in rows if r.source == "bad0"} == {True, False}
    # Symbols count for the host, not for the document.
    assert [r.kept for r in rows if r.source == "tiny"] == [False, False, False, True]
    assert [(r.symbols, r.base_failed) for r in rows if r.source == "tiny"][-1] == (True, False)


def verdicts_by_hand(counts, factor, deviations):
    """The method's formulas over {host: (documents, failed)}, by sums over hosts written out."""
    docs, bad = sum(n for n, _ in counts.values()), sum(f for _, f in counts.values())
    mean = (bad + 0.5) / (docs + 1)
    free = docs - sum(n * n for n, _ in counts.values()) / docs - (len(counts) - 1)
    between = sum(n * (f / n - bad / docs) ** 2 for n, f in counts.values())  # the weighted spread of rates
    share = (between / (mean * (1 - mean)) - (len(counts) - 1)) / free if free > 0 else 0.5
    share = min(max(share, 1e-4), 0.99)
    a, b = mean * (1 - share) / share, (1 - mean) * (1 - share) / share
    most = factor * mean / (1 - mean) / (1 + factor * mean / (1 - mean))
    out = {}
    for h, (n, f) in counts.items():
        x, y = a + f, b + n - f  # the posterior beta distribution
        out[h] = (x / (x + y), x / (x + y) - deviations * (x * y / ((x + y) ** 2 * (x + y + 1))) ** 0.5 <= most)
    return out


@pytest.mark.parametrize("factor, deviations", [(2.0, 3.0), (1.2, 1.0)])
def test_prior_and_verdicts_equal_the_formulas(spark, factor, deviations):
    rng = random.Random(3)
    counts = {f"h{i}": (n, sum(rng.random() < rate for _ in range(n))) for i in range(60)
              for n, rate in [(rng.choice([1, 2, 10, 80, 300]), rng.choice([0.1, 0.15, 0.2, 0.45]))]}
    df = spark.createDataFrame([(h, i < f) for h, (n, f) in counts.items() for i in range(n)] + [(None, True)], "host string, failed boolean")
    expected = verdicts_by_hand(counts, factor, deviations)
    found = {r.host: (r.host_rate, r.host_kept) for r in host_verdicts(df, HostRules(host_odds=factor, host_deviations=deviations)).collect()}
    assert set(found) == set(expected) and 0 < sum(not kept for _, kept in expected.values()) < 30
    for h, (rate, kept) in expected.items():
        assert found[h] == (pytest.approx(rate), kept)


def test_shrinkage_draws_small_hosts_to_the_mean(spark):
    rows = [(f"h{k}", i < 30) for k in range(20) for i in range(100)] + [("one", True), (None, True)]
    rate = {r.host: r.host_rate for r in host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    assert None not in rate and 0.3 < rate["one"] < 0.5 and abs(rate["h0"] - 0.3) < 0.02


def test_query_equals_sql(spark, folder):
    assert difference(op3_host_rules(spark, folder), folder, ORACLES["op3_host_rules"]) is None


def test_prior_of_no_and_one_host():
    assert _beta_prior(0, 0.0, 0.0, 0.0, 0.0) == (0.5, 0.5)
    a, b = _beta_prior(1, 10.0, 10.0, 100.0, 10.0)
    assert a > 0 and b > 0


def test_awkward_rows(awkward, nothing):
    rows = host_quality(awkward, HostRules(min_words=5)).collect()
    assert len(rows) == awkward.count()
    empty = [r for r in rows if r.doc_id in (3, 4, 5)]
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in empty)
    nowhere = [r for r in rows if r.source is None and r.n_words]
    assert all(r.host_rate is None and r.host_kept and r.kept for r in nowhere) and nowhere
    assert host_quality(nothing).count() == 0
    assert set(COUNTS) <= set(host_quality(nothing).columns)
