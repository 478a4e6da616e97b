"""The four kinds of failure a mailbox source reports."""


class MailboxError(Exception):
    """Base of all."""


class IoError(MailboxError):
    """A file could not be read."""


class FormatError(MailboxError):
    """Bytes or a path are not what the format allows."""


class UnsupportedError(MailboxError):
    """Valid, but not something this engine reads."""


class NotFoundError(MailboxError):
    """No such folder, message or attachment."""
