"""Files of any store that Python workers can open by address: listing, and reading by seek."""

from __future__ import annotations

import fnmatch
from typing import BinaryIO

from pyarrow import fs


def located(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it. Without a scheme, or with file:, it is one that all hosts mount."""
    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address[5:].lstrip("/")
    return fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)


def listed(address: str, suffixes: tuple[str, ...] = ()) -> list[tuple[str, int]]:
    """(address, bytes) of a file, of the files of a folder, or of those that the last part of an address matches, by name.

    Hidden and unfinished files, whose names start with a dot or a low line, are left out.
    """
    system, path = located(address)
    front = address[: len(address) - len(path)] if address.endswith(path) else "file://"
    found = system.get_file_info(path) if not any(c in path for c in "*?[") else None
    if found is not None and found.type == fs.FileType.File:
        return [(front + path, found.size)]
    folder, pattern = (path.rstrip("/"), "*") if found is not None else path.rsplit("/", 1)
    files = [i for i in system.get_file_info(fs.FileSelector(folder)) if i.type == fs.FileType.File and i.base_name[0] not in "._"]
    return sorted((front + i.path, i.size) for i in files if fnmatch.fnmatch(i.base_name, pattern) and (not suffixes or i.base_name.lower().endswith(suffixes)))


def opened(address: str) -> BinaryIO:
    """A file for reading by seek."""
    system, path = located(address)
    return system.open_input_file(path)


class Bounds:
    """Filters on whole-number columns that a source can decide by itself, kept as predicates on a dict of values."""

    def __init__(self, columns: tuple[str, ...]):
        self.columns, self.tests = columns, []

    def take(self, filters: list) -> list:
        """Keep what bounds the columns; the filters that stay for Spark."""
        kinds = {"EqualTo": "=", "EqualNullSafe": "=", "GreaterThan": ">", "GreaterThanOrEqual": ">=", "LessThan": "<", "LessThanOrEqual": "<=", "In": "in"}
        left = []
        for f in filters:
            kind = kinds.get(type(f).__name__)
            if type(f).__name__ == "IsNotNull" and f.attribute[0] in self.columns:
                continue  # these columns hold no nulls
            if kind is None or len(f.attribute) != 1 or f.attribute[0] not in self.columns or getattr(f, "value", 0) is None:
                left.append(f)
            else:
                self.tests.append((f.attribute[0], kind, tuple(f.value) if kind == "in" else f.value))
        return left

    def __call__(self, **values: int) -> bool:
        """Whether values, for some of the columns, can pass."""
        for column, kind, bound in self.tests:
            v = values.get(column)
            if v is not None and not {"=": lambda: v == bound, ">": lambda: v > bound, ">=": lambda: v >= bound, "<": lambda: v < bound, "<=": lambda: v <= bound, "in": lambda: v in bound}[kind]():
                return False
        return True

    def meets(self, column: str, first: int, last: int) -> bool:
        """Whether some value of the column from first to last can pass."""
        for name, kind, bound in self.tests:
            if name == column and not {"=": lambda: first <= bound <= last, ">": lambda: last > bound, ">=": lambda: last >= bound, "<": lambda: first < bound, "<=": lambda: first <= bound, "in": lambda: any(first <= b <= last for b in bound)}[kind]():
                return False
        return True
