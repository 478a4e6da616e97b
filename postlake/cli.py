"""python -m postlake.cli STORE ACTION: one action a run, one JSON document on stdout."""

from __future__ import annotations

import argparse
import json
import sys

from postlake import __version__
from postlake.errors import MailboxError, NotFoundError, UnsupportedError
from postlake.plans.mailbox import BODY_CHARS, CLI_ROWS, PAYLOAD_BYTES


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="postlake")
    p.add_argument("store", nargs="?", help="a .ost or .pst file, a Mac profile, or a folder of parquet tables")
    one = p.add_mutually_exclusive_group(required=True)
    one.add_argument("--info", action="store_true")
    one.add_argument("--list", action="store_true")
    one.add_argument("--sql")
    one.add_argument("--message", type=int)
    one.add_argument("--attachments", type=int)
    one.add_argument("--attachment", metavar="MSG:ATT")
    one.add_argument("--version", action="version", version=__version__)
    p.add_argument("--out")
    p.add_argument("--limit", type=int, default=CLI_ROWS)
    p.add_argument("--max-body-chars", type=int, default=BODY_CHARS)
    p.add_argument("--max-bytes", type=int, default=PAYLOAD_BYTES)
    return p


def run(args: argparse.Namespace, box=None):
    """The document of an action."""
    from postlake.plans import shape
    from postlake.session import session
    from postlake.sources import discover

    if args.list:
        return [s.as_dict() for s in discover.stores()]
    box = box or discover.open_store(session(), args.store)
    if args.info:
        return box.store_info()
    if args.sql is not None:
        if args.limit < 1:
            raise UnsupportedError("--limit must be at least 1")
        return shape.reply(box.query(args.sql), args.limit)["rows"]
    if args.message is not None:
        return box.get_message(args.message, args.max_body_chars)
    if args.attachments is not None:
        return box.list_attachments(args.attachments)
    try:
        message, attachment = (int(x) for x in args.attachment.split(":"))
    except ValueError:
        raise UnsupportedError("--attachment takes MESSAGE:ATTACHMENT") from None
    if args.out:
        return box.save_attachment(message, attachment, args.out)
    return box.read_attachment(message, attachment, args.max_bytes)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        print(json.dumps(run(args), indent=2, ensure_ascii=False))
    except NotFoundError as e:
        print(f"not found: {e}", file=sys.stderr)
        return 2
    except MailboxError as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
