"""Where things lie below a data root, in any store that Spark reaches."""

from __future__ import annotations

from dataclasses import dataclass

#: The account level of components that talk to no broker: explicit, so that a missing level can't be mistaken for it.
NO_ACCOUNT = "no-account"


@dataclass(frozen=True)
class Layout:
    root: str

    def _at(self, *parts: str) -> str:
        if not all(parts):
            raise ValueError(f"an empty level in {parts}")
        return "/".join([self.root.rstrip("/"), *parts])

    def raw(self, feed: str) -> str:
        return self._at("raw", feed)

    def reference(self, feed: str) -> str:
        return self._at("reference", feed)

    @property
    def ticks(self) -> str:
        return self._at("ticks")

    @property
    def bars(self) -> str:
        return self._at("bars")

    @property
    def windows(self) -> str:
        return self._at("windows")

    @property
    def reports(self) -> str:
        return self._at("reports")

    def logs(self, comp: str, alias: str, account_hash: str | None = None) -> str:
        """Two accounts of one terminal never share a folder."""
        return self._at("logs", comp, alias, account_hash or NO_ACCOUNT)
