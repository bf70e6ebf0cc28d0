"""Policy of a connector that lands bytes: what may be asked, how often, and what an answer means.

The transport is injected, so nothing here opens a connection by itself; queries read what was landed. `LandedSource` is a
Spark data source with one partition per registered source, for jobs that do land.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

AGENT = "chronodiff-collector/1.0"
#: Answers that may pass by themselves, and those that withdraw a source.
TRANSIENT, REVOKED = {408, 500, 502, 503, 504}, {401, 403, 429}
#: Headers of an answer that may be stored.
KEPT_HEADERS = {"content-type", "content-length", "etag", "last-modified", "date", "cache-control", "retry-after"}
_CREDENTIAL = ("token", "key", "secret", "auth", "password", "signature", "credential", "session")


class FetchRefused(Exception):
    """The request breaks the policy and isn't sent: unregistered, excluded, a credential in the URL, robots, another endpoint."""


class SourceRevoked(Exception):
    """The source withdrew its consent or challenges bots; never asked again."""


class SourceFailed(Exception):
    """No usable answer: too large, not found, or transient to the last attempt."""


@dataclass
class Answer:
    status: int
    headers: dict[str, str]
    body: bytes
    chain: list[str] = field(default_factory=list)


@dataclass
class Policy:
    """Limits of all requests. ``sleep``, ``clock`` and ``chance`` are replaced in tests."""

    attempts: int = 3
    backoff_s: float = 1.0
    jitter: float = 0.5
    delay_s: float = 1.0
    most_bytes: int = 16 * 1024 * 1024
    robots_ttl_s: float = 24 * 3600
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    chance: Callable[[], float] = random.random


def challenge(answer: Answer) -> bool:
    """Whether an answer is a challenge to bots rather than content."""
    head = answer.body[:4096].lower()
    return answer.headers.get("cf-mitigated", "").lower() == "challenge" or (answer.status in (403, 503) and (b"captcha" in head or b"challenge-platform" in head))


def kept_headers(headers: dict[str, str]) -> dict[str, str]:
    return {k.lower(): v for k, v in headers.items() if k.lower() in KEPT_HEADERS}


class Fetcher:
    """Asks registered sources by ``transport(method, url, headers) -> Answer``; writes each request to ``log``."""

    def __init__(self, sources: list[dict], transport: Callable[[str, str, dict], Answer], policy: Policy | None = None):
        self.sources = {s["source_id"]: s for s in sources}
        if len(self.sources) != len(sources):
            raise ValueError("a source id occurs twice")
        host = lambda s: urlsplit(s["url"]).netloc.lower()
        self.hosts = {host(s) for s in sources if not s.get("excluded")}
        self.excluded = {host(s) for s in sources if s.get("excluded")}
        self.transport, self.policy = transport, policy or Policy()
        self.robots: dict[str, tuple[float, RobotFileParser | None]] = {}
        self.asked: dict[str, float] = {}
        self.validators: dict[str, dict[str, str]] = {}
        self.log: list[dict] = []

    def _admit(self, source: dict, url: str) -> None:
        u = urlsplit(url)
        home = urlsplit(source["url"])
        if source.get("excluded") or u.netloc.lower() in self.excluded:
            raise FetchRefused("excluded")
        if (u.scheme, u.netloc.lower(), u.path) != (home.scheme, home.netloc.lower(), home.path):
            raise FetchRefused("another endpoint than registered")
        names = [p.partition("=")[0].lower() for p in u.query.split("&")]
        if u.username or u.password or any(w in n for n in names for w in _CREDENTIAL):
            raise FetchRefused("credential in the URL")
        if not self._allowed(u):
            raise FetchRefused("robots")

    def _allowed(self, u) -> bool:
        at, rules = self.robots.get(u.netloc, (None, None))
        if at is None or self.policy.clock() - at > self.policy.robots_ttl_s:
            a = self.transport("GET", f"{u.scheme}://{u.netloc}/robots.txt", {"User-Agent": AGENT})
            if a.status >= 500 or a.status == 429:
                raise SourceFailed("robots.txt can't be reached")
            rules = RobotFileParser()
            rules.parse(a.body.decode("utf-8", "replace").splitlines() if a.status < 300 else [])
            self.robots[u.netloc] = (self.policy.clock(), rules)
        return rules.can_fetch(AGENT, u.geturl())

    def _wait(self, host: str) -> None:
        due = self.asked.get(host, float("-inf")) + self.policy.delay_s
        if (now := self.policy.clock()) < due:
            self.policy.sleep(due - now)
        self.asked[host] = self.policy.clock()

    def fetch(self, source_id: str, url: str | None = None) -> Answer | None:
        """The answer, or None if the source is unchanged (304). All gates come before the first request."""
        source = self.sources.get(source_id)
        if source is None:
            raise FetchRefused("unregistered")
        url = url or source["url"]
        self._admit(source, url)
        p, headers = self.policy, {"User-Agent": AGENT, **self.validators.get(source_id, {})}
        for attempt in range(p.attempts):
            if attempt:
                p.sleep(p.backoff_s * 2 ** (attempt - 1) + p.chance() * p.jitter * p.backoff_s)
            self._wait(urlsplit(url).netloc)
            a = self.transport("GET", url, headers)
            self.log.append({"source_id": source_id, "url": url, "status": a.status, "attempt": attempt + 1})
            if challenge(a) or a.status in REVOKED:
                raise SourceRevoked(source_id)
            if a.status not in TRANSIENT:
                break
        if a.status == 304:
            return None
        if not 200 <= a.status < 300:
            raise SourceFailed(f"status {a.status}")
        if len(a.body) > p.most_bytes:
            raise SourceFailed("too large")
        seen = {urlsplit(x).netloc.lower() for x in a.chain}
        if seen & self.excluded or not seen <= self.hosts:
            raise FetchRefused("redirected to a host that isn't cleared")
        a.headers = kept_headers(a.headers)
        self.validators[source_id] = {k: a.headers[v] for k, v in (("If-None-Match", "etag"), ("If-Modified-Since", "last-modified")) if v in a.headers}
        return a

    def pages(self, source_id: str, next_of: Callable[[Answer], str | None], most: int = 40) -> list[Answer]:
        """All pages of a source; more than ``most`` fail, as a part must not pass as a snapshot."""
        out, url = [], None
        while True:
            a = self.fetch(source_id, url)
            if a is None:
                return out
            out.append(a)
            if not (url := next_of(a)):
                return out
            if len(out) >= most:
                raise SourceFailed("too many pages")


def header_faults(source: dict, agent: str, headers: dict[str, str], credentials: set[str] = frozenset({"authorization", "cookie", "x-api-key", "api-key"})) -> list[str]:
    """Why a request's headers break the policy: an agent other than the registered one, or a credential for a source that must never get one."""
    names = {k.lower(): v for k, v in headers.items()}
    out = [] if names.get("user-agent", agent) == agent else ["user-agent"]
    return out + ([f"credential {k}" for k in sorted(names) if k in credentials] if source.get("never_authenticate") or source.get("auth") in (None, "none") else [])


def heartbeat(ok: bool, url: str | None, post: Callable[[str, float], int], timeout_s: float = 10.0) -> str:
    """Tells a monitor that a run ended: `sent`, `skipped` without a URL, `refused` if it isn't https, or `failed`. It never raises."""
    if not url:
        return "skipped"
    if urlsplit(url).scheme != "https":
        return "refused"
    try:
        return "sent" if 200 <= post(url if ok else url.rstrip("/") + "/fail", timeout_s) < 300 else "failed"
    except Exception:  # noqa: BLE001  a run doesn't fail by its monitor
        return "failed"


class _Source(InputPartition):
    def __init__(self, record: dict):
        self.record = record


class _Reader(DataSourceReader):
    def __init__(self, sources: list[dict], transport):
        self.sources, self.transport = sources, transport

    def partitions(self):
        return [_Source(s) for s in self.sources]

    def read(self, partition):
        s = partition.record
        try:
            a = Fetcher(self.sources, self.transport).fetch(s["source_id"])
            yield (s["source_id"], None if a is None else a.status, None if a is None else a.body, None)
        except (FetchRefused, SourceRevoked, SourceFailed) as e:
            yield (s["source_id"], None, None, f"{type(e).__name__}: {e}")


def landed_source(name: str, sources: list[dict], transport) -> type[DataSource]:
    """A data source named ``name`` with the columns (source_id, status, body, error), one partition per source; a failed source doesn't fail the others."""

    class LandedSource(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "source_id string, status int, body binary, error string"

        def reader(self, schema):
            return _Reader(sources, transport)

    return LandedSource
