"""Fewer, larger files: small files of a table are packed into new ones beside running readers."""

from __future__ import annotations

import math
import time
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame

from candlewick.session import stage
from candlewick.tables.store import LOAD, Table

#: Size that files should have, how many files of one size class are packed together, and how far sizes of a class differ.
TARGET_BYTES, FAN_IN = 128 << 20, 8


def small_files(sizes: dict[str, int], target: int = TARGET_BYTES, fan_in: int = FAN_IN) -> list[str]:
    """Files to be packed: of each folder the size classes (powers of `fan_in`) that hold `fan_in` files or more.

    A row is packed again only when its file has grown into the next class, so a table that grows by appends writes
    each row about log(target / append) times, and keeps fewer than `fan_in` files of a class per folder.
    """
    classes: dict[tuple, list[str]] = defaultdict(list)
    for file, size in sizes.items():
        if size < target:
            folder = "/".join(p for p in file.split("/")[:-1] if not p.startswith(f"{LOAD}="))
            classes[folder, int(math.log(max(size, 1), fan_in))].append(file)
    return sorted(f for files in classes.values() if len(files) >= fan_in for f in files)


def compact(table: Table, target: int = TARGET_BYTES, fan_in: int = FAN_IN) -> int:
    """Packs small files into one new load; the number of files packed, 0 where nothing was to be done.

    The new version has the same rows. Older kept versions, and readers of them, keep the files that they list.
    """
    sizes = table.files()
    chosen = small_files(sizes, target, fan_in)
    if not chosen:
        return 0
    rows = table.of_files(chosen)
    if not table.partition_by:  # partitioned ones are laid out by size on writing
        rows = rows.coalesce(max(1, math.ceil(sum(sizes[f] for f in chosen) / target)))
    table.replace_files(rows, chosen)
    return len(chosen)


def append(table: Table, df: DataFrame, target: int = TARGET_BYTES, fan_in: int = FAN_IN, notes: dict | None = None) -> None:
    """Appends to a table, and packs its small files once enough loads have come together."""
    if not table.exists():
        table.replace(df, notes=notes)
        return
    table.append(df, notes)
    if len(table.manifest()["loads"]) % fan_in == 0:
        compact(table, target, fan_in)


class Landing:
    """Rows of numbered batches, held back until there are enough of them by number, size or age.

    A batch enters the waiting table at once, together with its number. A flush moves all waiting rows to the target in
    one load, which notes the last number, and empties the waiting table. Batches up to a noted number are not taken
    again, and rows that the target has already are not moved again, so a failure at any place neither loses nor
    doubles a row.
    """

    def __init__(
        self, target: Table, waiting: Table, rows: int = 10_000, size: int = 5_000_000, seconds: float = 60.0,
        clock: Callable[[], float] = time.time,
    ):
        self.target, self.waiting, self.rows, self.size, self.seconds, self.clock = target, waiting, rows, size, seconds, clock
        if self.waiting.notes().get("rows") and self.target.notes().get("batch", -1) >= self.waiting.notes()["batch"]:
            self._emptied()  # the flush before had reached the target

    def _emptied(self) -> None:
        self.waiting.empty({"rows": 0, "since": None})

    def take(self, batch: DataFrame, number: int) -> bool:
        """Brings in one batch; whether the waiting rows were flushed after it."""
        notes = self.waiting.notes()
        if number > notes.get("batch", -1):
            batch = stage(batch, "landing")
            n = batch.count()
            if n:
                held = {"batch": number, "rows": notes.get("rows", 0) + n, "since": notes.get("since") or self.clock()}
                append(self.waiting, batch, notes=held)
        if self.due():
            self.flush()
            return True
        return False

    def due(self) -> bool:
        notes = self.waiting.notes()
        if not notes.get("rows"):
            return False
        old = self.clock() - notes["since"] >= self.seconds
        return old or notes["rows"] >= self.rows or sum(self.waiting.files().values()) >= self.size

    def flush(self) -> None:
        """Moves all waiting rows, whatever their number."""
        notes = self.waiting.notes()
        if notes.get("rows"):
            files = max(1, math.ceil(sum(self.waiting.files().values()) / TARGET_BYTES))
            append(self.target, self.waiting.read().coalesce(files), notes={"batch": notes["batch"]})
            self._emptied()
