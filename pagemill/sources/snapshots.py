"""Versions of a stored table: small files that say which folders make it up.

Data go to folders that no version names yet. A commit writes the next version's file aside and
renames it, so a reader sees the version before or the whole new one, and a write that dies at
any point leaves the version before in force. The folders of the last KEPT versions
stay, for readers that are still at them; what only older versions name is deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from pagemill.sources.paths import names_in, read_text, remove, replace_text

KEPT = 2


class Snapshots:
    """The versions below `path`. A version's content is a dict; its `folders` are relative to `path`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._known: dict[int, set[str]] = {}

    def _file(self, version: int) -> str:
        return f"{self.path}/_versions/{version:012d}.json"

    def versions(self) -> list[int]:
        names = names_in(self.spark, f"{self.path}/_versions")
        return [int(name[:12]) for name in names if name.endswith(".json") and name[:12].isdigit()]

    def latest(self, before: int | None = None) -> tuple[int, dict] | None:
        """Number and content of the last version, or of the last one below `before`."""
        known = [v for v in self.versions() if before is None or v < before]
        return (known[-1], json.loads(read_text(self.spark, self._file(known[-1])))) if known else None

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def commit(self, version: int, content: dict) -> None:
        """Put a version in force. Committing it again, as a repeated write does, replaces it."""
        known = [v for v in self.versions() if v != version]
        replace_text(self.spark, self._file(version), json.dumps(content))
        self._known[version] = set(content["folders"])
        kept = sorted([*known, version])[-KEPT:]
        held = {f for v in kept for f in self._folders(v)}
        for old in (v for v in known if v < kept[0]):
            for folder in self._folders(old) - held:
                remove(self.spark, self.folder(folder))
            remove(self.spark, self._file(old))

    def _folders(self, version: int) -> set[str]:
        if version not in self._known:
            self._known[version] = set(json.loads(read_text(self.spark, self._file(version)))["folders"])
        return self._known[version]
