"""URL filter: allow and block rules in a trie over reversed host labels and path segments.

The rules go to all tasks as a broadcast, whose size ``MOST_RULES`` bounds.
"""

from __future__ import annotations

import re
import string
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame

from casebook.llm.common import prepared, with_columns

MOST_RULES = 1_000_000
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_SEGMENTS = re.compile(r"[^/]*/|[^/]+$")


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL: the host ends at /, ?, # or the end, the path at ?, # or the end.

    Both are empty without ``://``. A-Z of the host are lower-cased; ports and names before an @
    stay part of it.
    """
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


class Trie:
    """Rules by host, deepest label last, and below a host by path.

    A node is a dict from label to node; under "" it holds the paths of the rules that end there,
    themselves a trie of whole segments. A rule's last segment may be part of one: such rules hang
    under their node as (text, rule), longest first.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")) if host else ():
                node = node.setdefault(label, {})
            paths = node.setdefault("", {})
            for segment in _SEGMENTS.findall(path):
                if segment.endswith("/"):
                    paths = paths.setdefault(segment, {})
                    continue
                parts = paths.setdefault(None, {})
                parts[segment] = self.stronger(parts.get(segment), (host + path, verdict))
                paths = None
            if paths is not None:
                paths[""] = self.stronger(paths.get(""), (host + path, verdict))

    @staticmethod
    def stronger(old: tuple[str, str] | None, new: tuple[str, str]) -> tuple[str, str]:
        """Of an allow and a block entry for the same place, the allow entry."""
        return old if old and old[1] == "allow" else new

    def of_path(self, paths: dict, path: str) -> tuple[str, str] | None:
        """The longest rule that the path starts with."""
        best, at = paths.get(""), 0
        while True:
            rest = path[at:]
            parts = [p for p in paths.get(None, ()) if rest.startswith(p)]
            if parts:
                best = paths[None][max(parts, key=len)]
            slash = rest.find("/")
            if slash < 0:
                return best
            paths = paths.get(rest[: slash + 1])
            if paths is None:
                return best
            best, at = paths.get("", best), at + slash + 1

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """The rule for a URL: that of the longest host, then of the longest path."""
        nodes, node = [self.root], self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.get(label) if label else None
            if node is None:
                break
            nodes.append(node)
        for node in reversed(nodes):
            found = self.of_path(node[""], path) if "" in node else None
            if found:
                return found
        return None


_TRIES: dict[str, Trie] = {}


def filter_urls(df: DataFrame, rules: Iterable[tuple[str, str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict of each row's URL; one pass without a shuffle.

    ``rules`` are (host, path, verdict). A rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest host wins, then the longest path; of equal rules an allow
    entry wins. An empty host fits every URL. Without a rule the verdict is ``default`` and the
    rule null. Null URLs and those without ``://`` have empty host and path. Repeated rows stay;
    existing columns of the added names are replaced; an empty table stays empty. More than
    ``MOST_RULES`` rules raise ``ValueError``.
    """
    rules = list(rules)
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} are broadcast")
    sent, key = prepared(df.sparkSession).sparkContext.broadcast(rules), uuid.uuid4().hex

    def task():
        # Built once in each worker, not in each of its tasks.
        if key not in _TRIES:
            _TRIES.clear()
            _TRIES[key] = Trie(sent.value)
        trie = _TRIES[key]

        def compute(urls):
            parts = [split_url(u) for u in urls]
            found = [trie.find(*p) or (None, default) for p in parts]
            return [p[0] for p in parts], [p[1] for p in parts], [f[0] for f in found], [f[1] for f in found]

        return compute

    return with_columns(df, [url], {"host": "string", "path": "string", "rule": "string", "verdict": "string"}, task)
