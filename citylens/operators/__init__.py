"""DataFrame -> DataFrame operators (usable on batch and streaming frames
unless noted)."""

from . import detect, enrich, quality, reports, sequence, windows  # noqa: F401
