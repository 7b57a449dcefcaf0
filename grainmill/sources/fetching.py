"""Getting files of upstream sources into a folder of their own, verified and whole.

Redirects are followed here, to named hosts alone; only the host that was asked first is told
the token. A file is hashed while it is written beside its place, and takes its place when it is
whole and its hash is the wanted one. What is there already is hashed again before it is used.
The folder must be one that executors see, too.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path
from urllib.parse import urljoin, urlsplit

AGENT, TIMEOUT_S, MOST_HOPS, CHUNK = "grainmill", 120, 8, 1 << 20
#: The hosts that files come from; names below them count, too.
HOSTS = ("huggingface.co", "hf.co", "raw.githubusercontent.com")


class Unavailable(Exception):
    """A source can't be had. ``facts`` says what is known, with a ``reason``."""

    def __init__(self, what: str, reason: str, **facts):
        super().__init__(f"{what}: {reason}")
        self.facts = {"reason": reason} | facts


class _EveryAnswer(urllib.request.HTTPErrorProcessor):
    """Takes redirects and errors for answers like any other."""

    def http_response(self, request, response):
        return response

    https_response = http_response


def ask(request: urllib.request.Request):
    return urllib.request.build_opener(_EveryAnswer()).open(request, timeout=TIMEOUT_S)


def allowed(host: str | None) -> bool:
    return any(host == h or (host or "").endswith(f".{h}") for h in HOSTS)


def answer(url: str, token: str | None = None, send: Callable = ask):
    """The open answer to a request, at the end of its redirects."""
    first, what = urlsplit(url).hostname, urlsplit(url).path
    for _ in range(MOST_HOPS):
        at = urlsplit(url)
        if at.scheme != "https" or not allowed(at.hostname):
            raise Unavailable(what, "host_not_allowed")
        headers = {"User-Agent": AGENT}
        if token and at.hostname == first:
            headers["Authorization"] = f"Bearer {token}"
        try:
            got = send(urllib.request.Request(url, headers=headers))
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            raise Unavailable(what, type(e).__name__) from None
        if got.status // 100 == 3 and got.headers.get("Location"):
            url = urljoin(url, got.headers["Location"])
            got.close()
        elif got.status == 200:
            return got
        else:
            got.close()
            raise Unavailable(what, f"http_{got.status}")
    raise Unavailable(what, "too_many_redirects")


def inside(name: str) -> str:
    """The name, unless it is absolute or leads upwards."""
    if os.path.isabs(name) or ".." in Path(name).parts:
        raise ValueError(f"the file name {name} leads out of its folder")
    return name


def hash_of(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def stored(url: str, folder: Path, name: str, sha256: str | None = None, token: str | None = None, send: Callable = ask) -> tuple[Path, str]:
    """A file of the folder, fetched if it isn't there, and its hash. Another hash than the wanted one is an error."""
    place = Path(folder) / inside(name)
    if place.exists():
        have = hash_of(place)
        if sha256 not in (None, have):
            raise ValueError(f"{name} in the folder has another checksum than the pinned one")
        return place, have
    place.parent.mkdir(parents=True, exist_ok=True)
    have = hashlib.sha256()
    with answer(url, token, send) as source, tempfile.NamedTemporaryFile(dir=place.parent, prefix=".incoming-", delete=False) as out:
        try:
            while part := source.read(CHUNK):
                out.write(part)
                have.update(part)
            out.close()
            if sha256 not in (None, have.hexdigest()):
                raise ValueError(f"{name} as sent has another checksum than the pinned one")
            os.replace(out.name, place)
        except BaseException as e:
            os.unlink(out.name)
            if isinstance(e, (TimeoutError, ConnectionError)):
                raise Unavailable(name, type(e).__name__) from None
            raise
    return place, have.hexdigest()
