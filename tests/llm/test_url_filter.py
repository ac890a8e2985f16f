from shroud.llm import url_filter as U
from shroud.llm.queries import URL_RULES

CASES = [
    ("http://a.net/x", "net/", "block"),
    ("http://a.net", None, "allow"),                       # an empty path does not start with /
    ("HTTP://NET/?q", "net/", "block"),
    ("https://w.example.net/en/1?x=/de/", "example.net/en/", "allow"),
    ("https://example.net/en", "net/", "block"),
    ("https://badexample.net/en/1", "net/", "block"),
    ("https://example.com/de/", "example.com/de/", "block"),
    ("https://a.org/fr/2#top", "org/fr/", "allow"),
    ("https://a.org/de/2", None, "allow"),
    ("a.net/x", None, "allow"), ("", None, "allow"), (None, None, "allow"),
    ("x://É.net/à", "net/", "block"),
]


def test_contract_rules(spark):
    df = spark.createDataFrame([(i, u, "mine") for i, (u, _, _) in enumerate(CASES)], "page_id int, url string, host string")
    got = {r.page_id: r for r in U.url_filter(df, URL_RULES).collect()}
    for i, (u, rule, verdict) in enumerate(CASES):
        assert (got[i].rule, got[i].verdict) == (rule, verdict), u
    assert got[2].host == "net" and got[2].path == "/" and got[11].host == "" and got[12].host == "É.net"


def _brute(rules, host, path):
    best = None
    for verdict, rule in rules:
        h, p = U.split_rule(rule)
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h.split(".")) if h else 0, len(p), verdict == "block")
            best = max(best, (key, rule, verdict)) if best else (key, rule, verdict)
    return best and best[1:]


def test_trie_against_brute_force():
    import itertools
    hosts = ["", "b", "a.b", "x.a.b", "xa.b", "c.b"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/q", "/english", "/en/q/r"]
    rules = [(v, h + p) for (h, p), v in zip(itertools.product(hosts[:4], ["/", "/en", "/en/", "/en/q"]),
                                            itertools.cycle(["allow", "block", "block"]))]
    for n in (1, 3, 7, len(rules)):
        for start in range(0, len(rules), 3):
            some = rules[start:start + n]
            trie = U.build_trie(some)
            for h, p in itertools.product(hosts, paths):
                assert U.match(trie, h, p) == _brute(some, h, p), (some, h, p)


def test_empty_table_and_no_rules(spark):
    df = spark.createDataFrame([], "page_id int, url string")
    assert U.url_filter(df, URL_RULES).count() == 0
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    assert U.url_filter(df, [], default="block").first().verdict == "block"
