"""Typed failures raised by the eager gates.

Every gate in :mod:`tidemark.operators.gates` raises one of these; callers can
catch :class:`WarehouseError` to handle any data-contract breach at once.
"""

from __future__ import annotations


class WarehouseError(Exception):
    """Base class of every data-contract failure raised by this library."""


class IntraBatchDuplicateError(WarehouseError):
    """A primary key occurs more than once inside one batch."""


class NullKeyError(WarehouseError, ValueError):
    """A merge or load key is NULL: it would never meet its own earlier copy."""


class SourceDataMissingError(WarehouseError):
    """An expected envelope, script block or root key is absent from a payload."""


class MalformedPayloadError(WarehouseError, ValueError):
    """A payload is there but is not the JSON it should be."""


class PayloadDriftError(MalformedPayloadError):
    """A payload is JSON of another shape than the registered one."""


class SelectorNotFoundError(WarehouseError):
    """An expected HTML structure (e.g. the injury grid) is absent from a page."""


class FutureDateError(WarehouseError):
    """A record is dated after the allowed processing bound."""


class SCD2TimelineException(WarehouseError):
    """A batch contradicts or overlaps the recorded history."""


class UnresolvedEntityError(WarehouseError):
    """A raw name has no entry in the governance mapping."""


class SourceMissingError(WarehouseError, FileNotFoundError):
    """A bronze or governance source path cannot be read."""


class DataQualityError(WarehouseError, ValueError):
    """One or more data-quality metrics fell below their threshold."""


class ContractViolationError(WarehouseError, ValueError):
    """A DataFrame does not match its registered schema contract."""


# Message fragments that callers match on.
MSG_UNRESOLVED = "Unresolved entity detected"
MSG_PK_COLLISION = "PK Collision"
MSG_GRID_MISSING = "Injury table not found"
MSG_DUP_PLAYER = "Duplicate player detected"
MSG_MATCH_INFO_MISSING = "match_info script tag not found"
MSG_DUP_SHOT = "Duplicate shot ID"
MSG_DUP_ROSTER = "Duplicate roster ID"
