"""Errors a run can end with.  ``retryable`` tells a scheduler whether another attempt can help."""

from __future__ import annotations


class RunError(Exception):
    """Base error; keyword arguments are kept as context and shown in the message."""

    retryable = False

    def __init__(self, message: str, **context):
        self.context = context
        shown = ", ".join(f"{name}={value}" for name, value in context.items())
        super().__init__(f"{message} [{shown}]" if shown else message)


class SourceMissing(RunError):
    """A drop or an upstream partition is not there (yet)."""

    retryable = True


class SourceMalformed(RunError):
    """A drop breaks its contract: header, field count or encoding."""


class SourceUnsteady(RunError):
    """A drop was not the same in two readings; it may still be arriving."""

    retryable = True


class QualityGateFailed(RunError):
    """A quality score or a post-load check is below what a run may pass with."""


class OrphanRecords(RunError):
    """Child records reference a parent that does not exist."""


class PublishRefused(RunError):
    """Staged output is incomplete or does not match what was computed."""


class LoadRefused(RunError):
    """A star-schema load would break a key or a count."""

    retryable = True
