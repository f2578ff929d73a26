from datetime import date, timedelta

from reviewgate.llm.url_filter import filter_urls, validity_intervals

D = date(2024, 1, 1)


def day(n):
    return None if n is None else D + timedelta(days=n)


EVENTS = [("l1", "host:example.com", 5, "add"), ("l1", "host:example.com", 9, "remove"),
          ("l1", "host:example.com", 7, "add"), ("l1", "host:example.com", 20, "add"),
          ("l1", "host:example.com", 20, "add"), ("l2", "path:a.org/x/y", 3, "add"),
          ("l2", "url:http://b.org/p?q=1", 0, "add"), ("l2", "host:gone.net", 4, "remove"),
          ("l2", "host:both.net", 4, "add"), ("l2", "host:both.net", 4, "remove"), (None, None, 1, "add"),
          ("l3", "host:example.com", None, "add"), ("l3", "host:com", 6, "add"), ("l3", "host:x.io", 1, "other")]
CAPTURES = [(i, u, d) for i, (u, d) in enumerate([
    ("http://example.com/", 4), ("http://example.com/", 5), ("https://u:p@Sub.EXAMPLE.com.:80/z", 8),
    ("http://example.com/", 9), ("http://example.com/", 25), ("http://notexample.com/", 2), ("http://a.org/x/y/z?k", 3),
    ("http://a.org/x/yy", 3), ("http://b.org/p?q=1#frag", 1), ("http://b.org/p?q=2", 1), ("http://gone.net", 9),
    ("http://both.net", 9), (None, 9), ("http://example.com/", None), ("not a url", 9), ("", 9), ("http:///x", 9)])]


def brute():
    state = {}
    for d in range(0, 40):
        for l, p, n, a in EVENTS:
            if n == d and p and a in ("add", "remove"):
                gone = any(e == (l, p, d, "remove") for e in EVENTS)
                state.setdefault((l, p), []).append((d, not gone))
    out = {}
    for i, u, d in CAPTURES:
        keys = set()
        if u and "://" in u:
            rest = u.split("://", 1)[1].split("#")[0]
            host = rest.split("/")[0].split("?")[0].split("@")[-1].split(":")[0].lower().rstrip(".")
            labels = [x for x in host.split(".") if x]
            keys |= {"host:" + ".".join(labels[k:]) for k in range(len(labels))}
            steps = [s for s in rest.split("?")[0].split("/")[1:] if s]
            keys |= {f"path:{host}/" + "/".join(steps[:k + 1]) for k in range(len(steps))}
        keys.add("url:" + (u or "").split("#")[0])
        lists = {l for (l, p), turns in state.items() if u is not None and d is not None and p in keys
                 and [on for n, on in turns if n <= d][-1:] == [True]}
        out[i] = len(lists)
    return out


def frames(spark, events=EVENTS, captures=CAPTURES):
    return (spark.createDataFrame([(i, u, day(d), "x") for i, u, d in captures],
                                  "page_id long, url string, fetch_date date, pattern string"),
            spark.createDataFrame([(l, p, day(d), a, "x") for l, p, d, a in events],
                                  "list_name string, pattern string, event_date date, action string, url string"))


def test_against_day_by_day(spark):
    got = filter_urls(*frames(spark)).collect()
    assert {r.page_id: r.n_lists for r in got} == brute()
    assert all((r.verdict == "blocked") == (r.n_lists > 0) == (r.pattern is not None) for r in got)
    assert {r.n_lists for r in got} >= {0, 1, 2}


def test_intervals(spark):
    rows = {(r.list_name, r.pattern, r.valid_from, r.valid_to) for r in validity_intervals(frames(spark)[1]).collect()}
    assert ("l1", "host:example.com", day(5), day(9)) in rows
    assert ("l1", "host:example.com", day(20), None) in rows
    assert not any(p == "host:both.net" for _, p, _, _ in rows) and len(rows) == 5


def test_repeats_and_empty(spark):
    captures, events = frames(spark, captures=CAPTURES[1:2] * 3)
    assert [r.verdict for r in filter_urls(captures, events).collect()] == ["blocked"] * 3
    assert filter_urls(*frames(spark, captures=[])).collect() == []
    assert {r.verdict for r in filter_urls(*frames(spark, events=[])).collect()} == {"allowed"}


def test_entries_without_a_list_name(spark):
    events = [(None, "host:example.com", 1, "add"), ("z", "host:example.com", 3, "add"), (None, "path:a.org/x", 1, "add")]
    got = {r.page_id: (r.verdict, r.n_lists, r.list_name, r.pattern) for r in filter_urls(*frames(
        spark, events, [(0, "http://example.com/", 2), (1, "http://example.com/", 4), (2, "http://a.org/x", 2),
                        (3, "http://b.org/", 2)])).collect()}
    assert got == {0: ("blocked", 1, None, "host:example.com"), 1: ("blocked", 2, "z", "host:example.com"),
                   2: ("blocked", 1, None, "path:a.org/x"), 3: ("allowed", 0, None, None)}
