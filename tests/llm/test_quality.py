from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    "a b c a b c",
    "a b a b a b a",
    "ab c d a bc d",
    "x y z\nx y z\n\n \n x y z",
    "# * $%&|<> é\U0001f600",
    "one two",
    "w " * 500,
    " ".join(f"w{i % 37} v{i % 11}" for i in range(3_000)),
]


@pytest.mark.parametrize("bits", [20, 4])
def test_measures_match_plain_counting(documents, monkeypatch, bits):
    monkeypatch.setattr(quality, "POSITION_BITS", bits)
    for r in quality.measures(documents(TEXTS)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(TEXTS[r.doc_id])


def test_order_changes_no_verdict(documents):
    docs = quality.measures(documents(TEXTS + [" ".join(f"word{i}" for i in range(80))]))
    forward, back = quality.rejected_by(list(quality.RULES)), quality.rejected_by(list(quality.RULES[::-1]))
    rows = docs.select("doc_id", forward.isNull().alias("a"), back.isNull().alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    assert [r.doc_id for r in rows if r.a] == [len(TEXTS)]


def test_rules_that_reject_more_per_cost_come_first(documents):
    docs = documents(["x " * 60] * 40 + [" ".join(f"w{i}" for i in range(90))] * 2)
    rules = (quality.Rule("never", "n_words < 0"), quality.Rule("often", "n_words = 60"))
    assert [r.name for r in quality.order_rules(docs, rules)] == ["often", "never"]


def test_odd_rows_and_empty_table(odd):
    rows = quality.verdicts(odd).collect()
    given = Counter(brute(r.text) for r in odd.collect())
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == given
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert quality.verdicts(odd.where(F.lit(False))).count() == 0


def test_plan_has_no_python_and_no_shuffle(odd):
    plan = quality.measures(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_a_rule_is_not_evaluated_after_a_rejection(documents):
    docs = quality.measures(documents(["short text", " ".join(f"w{i}" for i in range(90))]))
    fails = quality.Rule("fails", "raise_error(concat('seen: ', text)) is null")
    last = [quality.Rule("short", "n_words < 50"), quality.Rule("long", "n_words >= 50"), fails]
    assert {r.name for r in docs.select(quality.rejected_by(last).alias("name")).collect()} == {"short", "long"}
    with pytest.raises(Exception, match="seen: short text"):
        docs.where("n_words < 50").select(quality.rejected_by(last[::-1])).collect()


def test_of_rules_that_reject_the_same_the_cheaper_comes_first(documents):
    docs = documents([" ".join(f"w{i * j}" for i in range(8_000)) for j in range(200)])
    slow = quality.Rule("slow", "length(regexp_replace(text, '[^0-9]+', '')) >= 0 and doc_id % 2 = 0")
    rules = (slow, quality.Rule("fast", "doc_id % 2 = 0"))
    assert {tuple(r.name for r in quality.order_rules(docs, rules)) for _ in range(3)} == {("fast", "slow")}


def test_line_rules(documents):
    body = " ".join(f"word{i}" for i in range(60))
    texts = [body + "\n- a\n\t* b", "\n".join(f"• {body} {i}" for i in range(4)), "\n".join(f"{body} {i}... " for i in range(3)), body + "…\n" + body]
    rules = [r for r in quality.RULES if r.name in ("bullets", "ellipses")]
    rows = quality.measures(documents(texts)).select("doc_id", quality.rejected_by(rules).alias("name")).collect()
    assert {r.doc_id: r.name for r in rows} == {0: None, 1: "bullets", 2: "ellipses", 3: "ellipses"}
