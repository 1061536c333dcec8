"""Errors raised for bad data or bad parameters."""


class CurationError(Exception):
    """Base of every error this library raises itself."""


class ContractError(CurationError):
    """A table breaks its contract; ``messages`` lists each finding."""

    def __init__(self, title: str, messages: list[str]):
        self.messages = messages
        super().__init__(title + "".join(f"\n- {m}" for m in messages))


class MissingInputError(CurationError):
    """A required input path does not exist."""
