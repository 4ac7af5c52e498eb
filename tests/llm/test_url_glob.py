"""The wildcard automaton against plain string rules."""

import pytest
from hypothesis import given, settings, strategies as st

from casewise.llm.queries import URL_RULES
from casewise.llm.url_glob import GlobAutomaton, Rule, canonical, compile_rules, judge_urls

PART = st.text("abé./*", max_size=8)


def fits(rule, host, path):
    return (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(PART, PART), max_size=12), st.lists(st.tuples(PART, PART), min_size=1, max_size=30))
def test_automaton_equals_string_rules(urls, rules):
    rules = [Rule("block", *r) for r in rules]  # up to several 64-bit words
    table = compile_rules(rules).run([canonical(*u) for u in urls])
    assert table.tolist() == [[fits(rule, *url) for rule in rules] for url in urls]


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("no scheme.com/en/", "", "", None, "allow"),
        ("http://A.EXAMPLE.com/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://x.org/.com/", "x.org", "/.com/", None, "allow"),
        ("http://x.net?/es/", "x.net", "", None, "allow"),
        ("a://b://c.net/fr/", "b:", "//c.net/fr/", None, "allow"),
        ("http://é.net/es/\n1", "é.net", "/es/\n1", "net/es/", "block"),
        ("http://com", "com", "", None, "allow"),
        ("http://x.com/" + "y" * 200_000, "x.com", "/" + "y" * 200_000, "com/", "allow"),
    ],
)
def test_rules_of_the_query(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "clash"), (1, url, "clash")], "page_id long, url string, verdict string")
    rows = judge_urls(df, "url", URL_RULES).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [(host, path, rule, verdict)] * 2


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([("http://x.com/",)], "url string")
    assert judge_urls(df, "url", []).first().verdict == "allow"
    assert judge_urls(df.limit(0), "url", URL_RULES).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(97, 99), max_size=4), max_size=40), st.lists(st.lists(st.integers(97, 99), max_size=8), max_size=6))
def test_the_first_match_is_that_of_the_table(globs, texts):
    automaton = GlobAutomaton([[None, *glob] for glob in globs])
    table = automaton.run(texts)
    want = [int(row.argmax()) if row.any() else -1 for row in table]
    assert automaton.first(texts).tolist() == want
