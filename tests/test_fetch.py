"""The connector's policy with a recorded transport."""

import pytest

from chronodiff.sources.fetch import Answer, FetchRefused, Fetcher, Policy, SourceFailed, SourceRevoked, landed_source

SOURCES = [{"source_id": "a", "url": "https://a.example/list"}, {"source_id": "x", "url": "https://x.example/l", "excluded": True}, {"source_id": "b", "url": "https://b.example/list"}]


class Net:
    def __init__(self, *answers, robots="User-agent: *\nDisallow: /private\n"):
        self.answers, self.seen, self.slept, self.now, self.robots = list(answers), [], [], 0.0, robots

    def __call__(self, method, url, headers):
        self.seen.append((url, headers))
        return Answer(200, {}, self.robots.encode()) if url.endswith("/robots.txt") else self.answers.pop(0)

    def fetcher(self, sources=SOURCES, **k):
        def sleep(s):
            self.slept.append(s)
            self.now += s

        return Fetcher(sources, self, Policy(sleep=sleep, clock=lambda: self.now, chance=lambda: 1.0, **k))


OK = lambda body=b"{}", **h: Answer(200, h, body, ["https://a.example/list"])


def test_answers_and_validators():
    n = Net(OK(etag="e1", **{"Set-Cookie": "s"}), Answer(304, {}, b""))
    f = n.fetcher()
    assert f.fetch("a").headers == {"etag": "e1"} and f.fetch("a") is None
    assert n.seen[-1][1]["If-None-Match"] == "e1" and len([u for u, _ in n.seen if u.endswith("robots.txt")]) == 1 and n.slept == [1.0]


def test_retries():
    n = Net(Answer(503, {}, b""), Answer(500, {}, b""), OK())
    assert n.fetcher(delay_s=0).fetch("a").body == b"{}" and n.slept == [1.5, 2.5]
    with pytest.raises(SourceFailed):
        Net(*[Answer(503, {}, b"")] * 3).fetcher().fetch("a")


@pytest.mark.parametrize("source, url", [("none", None), ("x", None), ("a", "https://a.example/other"), ("a", "https://a.example/list?api_key=1"), ("a", "https://u:p@a.example/list")])
def test_refused_before_any_request(source, url):
    n = Net()
    with pytest.raises(FetchRefused):
        n.fetcher().fetch(source, url)
    assert n.seen == []


def test_robots_revocation_size_and_redirects():
    with pytest.raises(FetchRefused):
        Net(robots="User-agent: *\nDisallow: /list").fetcher().fetch("a")
    for a in (Answer(403, {}, b""), Answer(429, {}, b""), Answer(200, {"cf-mitigated": "challenge"}, b"")):
        with pytest.raises(SourceRevoked):
            Net(a, a).fetcher().fetch("a")
    with pytest.raises(SourceFailed):
        Net(OK(b"12345")).fetcher(most_bytes=4).fetch("a")
    for hop in ("https://x.example/l", "https://unknown.example/"):
        with pytest.raises(FetchRefused):
            Net(Answer(200, {}, b"", ["https://a.example/list", hop])).fetcher().fetch("a")


def test_pages():
    step = lambda a: f"https://a.example/list?page={len(a.body)}" if a.body != b"end" else None
    assert len(Net(OK(b"1"), OK(b"22"), OK(b"end")).fetcher().pages("a", step)) == 3
    with pytest.raises(SourceFailed):
        Net(*[OK(b"1")] * 3).fetcher().pages("a", step, most=2)


def test_repeated_id():
    with pytest.raises(ValueError):
        Fetcher([SOURCES[0], SOURCES[0]], None)


def test_data_source(spark):
    def transport(method, url, headers):
        from chronodiff.sources.fetch import Answer

        return Answer(404 if url.endswith("robots.txt") or "//b." in url else 200, {}, url.encode(), [url])

    spark.dataSource.register(landed_source("landed", SOURCES, transport))
    out = {r.source_id: (r.status, r.error) for r in spark.read.format("landed").load().collect()}
    assert out == {"a": (200, None), "x": (None, "FetchRefused: excluded"), "b": (None, "SourceFailed: status 404")}
