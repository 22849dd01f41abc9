"""Errors of the library: what failed and where, as data.

``SourceError`` is about files, ``RuleViolation`` about rules. Each carries its
facts as attributes; the message is put together from them in one place.
"""

from __future__ import annotations


class BasketryError(Exception):
    """Anything that the library raises on purpose."""


class SourceError(BasketryError):
    """A file that can't be read as declared. ``problem``: layout or encoding."""

    def __init__(self, problem: str, path: str, note: str):
        super().__init__(f"{path}: {note}")
        self.problem, self.path, self.note = problem, path, note


class RuleViolation(BasketryError):
    """A table that breaks a rule.

    ``rule`` is the rule's kind (required, no_extra, types, range, no_nulls,
    unique or fill); ``found`` maps each offending column to what was seen
    there, ``wanted`` says what the rule asks for.
    """

    def __init__(self, rule: str, found: dict[str, object], wanted: object = None):
        seen = ", ".join(f"{c}={v!r}" if v is not None else c for c, v in found.items())
        super().__init__(f"rule '{rule}' broken by {seen}" + (f"; wanted {wanted}" if wanted is not None else ""))
        self.rule, self.found, self.wanted = rule, found, wanted

    @property
    def columns(self) -> list[str]:
        return list(self.found)
