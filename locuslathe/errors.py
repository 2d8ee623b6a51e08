"""What validation can raise."""

from __future__ import annotations


class ValidationError(Exception):
    """Anything wrong with the inputs of a run."""


class ConfigurationError(ValidationError):
    """The configuration itself is wrong."""


class InputFileNotFoundError(ValidationError):
    """A file that the configuration names isn't there."""


class FileFormatError(ValidationError):
    """A file isn't in the format it should be in."""


class FastaFormatError(FileFormatError):
    pass


class GenBankFormatError(FileFormatError):
    pass


class BedFormatError(FileFormatError):
    pass


class GffFormatError(FileFormatError):
    pass


class FastqFormatError(FileFormatError):
    pass


class BamFormatError(FileFormatError):
    pass


class CompressionError(ValidationError):
    """A file can't be decompressed or compressed."""


class GenomeValidationError(ValidationError):
    pass


class FeatureValidationError(ValidationError):
    pass


class ReadValidationError(ValidationError):
    pass


class InterFileValidationError(ValidationError):
    """Files that should agree don't."""
