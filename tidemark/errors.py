"""Refusals: a job stops before it publishes anything from inputs it cannot vouch for."""


class RefusalError(RuntimeError):
    """An input, log or manifest is not what it must be."""


class PitBuildError(RefusalError):
    """Intervals cannot be proven from this log."""


class PolicyError(RefusalError):
    """A published row would carry what policy keeps back."""


class FetchError(RuntimeError):
    """A download failed for good; ``not_found`` tells an absent member from a broken one."""

    def __init__(self, message: str, *, not_found: bool = False):
        super().__init__(message)
        self.not_found = not_found
