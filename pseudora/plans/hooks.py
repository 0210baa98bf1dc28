"""Hooks on tables (what triggers are to a database): backed up, dropped, restored.

A hook is a named callable that the application runs before or after it writes a table;
its registration is plain metadata, so the same care applies: never drop what is not
backed up, never overwrite a backup, restore in firing order."""

from __future__ import annotations

from datetime import UTC, datetime

from ..sources.store import Store
from .model import ObfuscationError

FIELDS = ("trigger_name", "table_name", "action_timing", "event_manipulation", "action_order", "definer", "sql_mode", "action_statement")


def quoted_definer(definer: str) -> str:
    """user@host with both parts quoted; the host is what follows the last @."""
    user, _, host = definer.rpartition("@")
    return "`" + user.replace("`", "``") + "`@`" + host.replace("`", "``") + "`"


class Hooks:
    """The live hooks of targets, and their backup in the store."""

    def __init__(self, store: Store, live: dict[str, list[dict]] | None = None):
        self.store, self.live = store, live or {}

    def _backup(self, target: str) -> list[dict]:
        return [r for r in self.store.rows("hook_backup") if r["target_schema"] == target]

    def backup(self, target: str) -> int:
        if self._backup(target):
            raise ObfuscationError("a hook backup already exists for this target; restore it first")
        now = datetime.now(UTC).replace(tzinfo=None)
        rows = [{f: h.get(f) for f in FIELDS} | {"target_schema": target, "definer": quoted_definer(h.get("definer") or "@"), "backed_up_at": now} for h in self.live.get(target, [])]
        self.store.put("hook_backup", self.store.rows("hook_backup") + rows)
        return len(rows)

    def drop(self, target: str) -> tuple[int, int]:
        """(backed up, dropped); stops before dropping a hook that has no backup."""
        saved = 0 if self._backup(target) else self.backup(target)
        known = {r["trigger_name"] for r in self._backup(target)}
        if any(h["trigger_name"] not in known for h in self.live.get(target, [])):
            raise ObfuscationError("live hooks are missing from the backup; nothing was dropped")
        dropped = len(self.live.get(target, []))
        self.live[target] = []
        return saved, dropped

    def restore(self, target: str) -> int:
        """Recreates hooks in firing order; backup rows are spent."""
        have = {h["trigger_name"] for h in self.live.setdefault(target, [])}
        order = sorted(self._backup(target), key=lambda r: (r["table_name"], r["action_timing"], r["event_manipulation"], r["action_order"]))
        new = [{f: r[f] for f in FIELDS} for r in order if r["trigger_name"] not in have]
        self.live[target] += new
        self.store.put("hook_backup", [r for r in self.store.rows("hook_backup") if r["target_schema"] != target])
        return len(new)
