"""What can go wrong."""


class IngestError(Exception):
    """Any failure of the engine."""


class ConfigurationError(IngestError):
    """The configuration can't be used as it stands."""


class SourceError(IngestError):
    """A source couldn't be read."""


class DecodeError(SourceError):
    """A document isn't what its feed's settings say. Never carries content."""


class LandingError(IngestError):
    """A run couldn't be landed."""


class ManifestCommitError(LandingError):
    """All parts are there, but the manifest that seals them isn't."""


class CheckpointConflictError(IngestError):
    """Somebody else moved the checkpoint."""


class WatermarkRegressionError(IngestError):
    """The source's high watermark lies before the committed one."""


class SchemaChangeError(IngestError):
    """A change of schema that isn't an addition."""


class StatementError(IngestError):
    """A job on the cluster failed or took too long."""
