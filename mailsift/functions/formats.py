"""Formats: which suffix means what, and who reads it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

SINGLE, CONTAINER, UNKNOWN = "single_email", "container", "unknown"

# A reader of a container takes its bytes and yields (name, bytes); it may
# yield a Refused in place of an entry it cannot give.
Reader = Callable[[bytes], Iterator]


@dataclass(frozen=True)
class Refused:
    name: str | None
    reason: str


@dataclass(frozen=True)
class Format:
    name: str
    suffixes: tuple[str, ...]
    file_type: str
    supported: bool
    reader: Reader | None = None


# The formats, their file name suffixes and their classes.
# MSG and PST are known but have no reader.
BUILT_IN = (
    Format("eml", (".eml",), SINGLE, True),
    Format("html", (".html", ".htm"), SINGLE, True),
    Format("msg", (".msg",), UNKNOWN, False),
    Format("mbox", (".mbox",), CONTAINER, True),
    Format("pst", (".pst",), UNKNOWN, False),
    Format("zip", (".zip",), CONTAINER, True),
)


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def _look_up(values: dict[str, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(table, key), F.lit(UNKNOWN))


@dataclass(frozen=True)
class Formats:
    """An immutable set of formats; travels to the executors with the job."""

    items: tuple[Format, ...] = field(default=BUILT_IN)

    def register(
        self, suffix: str, kind: str, reader: Reader | None = None, name: str | None = None
    ) -> Formats:
        """A new set that also reads ``suffix``. A container needs a reader."""
        if kind not in (SINGLE, CONTAINER):
            raise ValueError(f"kind must be {SINGLE} or {CONTAINER}, not {kind}")
        if kind == CONTAINER and reader is None:
            raise ValueError("a container format needs a reader")
        suffix = "." + suffix.lower().lstrip(".")
        kept = tuple(
            replace(f, suffixes=tuple(s for s in f.suffixes if s != suffix)) for f in self.items
        )
        added = Format(name or suffix[1:], (suffix,), kind, True, reader)
        return Formats((*(f for f in kept if f.suffixes and f.name != added.name), added))

    def of(self, filename: str) -> Format | None:
        """The format with the longest matching suffix."""
        lower = filename.lower()
        found = [(len(s), f) for f in self.items for s in f.suffixes if lower.endswith(s)]
        return max(found, key=lambda pair: pair[0])[1] if found else None

    # -- column expressions -------------------------------------------------
    # Lookups in constant maps, so that an expression stays small however often
    # it is used inside another.

    def detect(self, filename: Column) -> Column:
        """Format of a file name by its suffix, case-insensitive; else unknown."""
        by_suffix = {s: f.name for f in self.items for s in f.suffixes}
        # The leftmost match at the end of the name is the longest suffix.
        pattern = "(" + "|".join(_quote(s) for s in by_suffix) + r")\z"
        return _look_up(by_suffix, F.regexp_extract(F.lower(filename), pattern, 1))

    def file_type(self, fmt: Column) -> Column:
        return _look_up({f.name: f.file_type for f in self.items}, fmt)

    def is_supported(self, fmt: Column) -> Column:
        return fmt.isin([f.name for f in self.items if f.supported])

    def can_parse(self, filename: Column, fmt: str) -> Column:
        """Whether the reader of one format takes this file name."""
        found = [f for f in self.items if f.name == fmt and f.supported]
        if not found:
            return F.lit(False)
        return self.detect(filename) == fmt

    def names_of(self, file_type: str) -> list[str]:
        return [f.name for f in self.items if f.file_type == file_type and f.supported]


DEFAULT = Formats()


def detect_format(filename: Column | str, formats: Formats = DEFAULT) -> Column:
    return formats.detect(F.col(filename) if isinstance(filename, str) else filename)


def file_type(fmt: Column | str, formats: Formats = DEFAULT) -> Column:
    return formats.file_type(F.col(fmt) if isinstance(fmt, str) else fmt)


def is_supported(fmt: Column | str, formats: Formats = DEFAULT) -> Column:
    return formats.is_supported(F.col(fmt) if isinstance(fmt, str) else fmt)


def skip_reason(fmt: Column) -> Column:
    """Reason for a file without a reader."""
    return F.when(
        fmt.isin("msg", "pst"), F.concat(fmt, F.lit("_not_supported"))
    ).otherwise(F.lit("unsupported_format"))
