"""python -m postlake.mcp STORE: the seven tools over the Model Context Protocol, JSON-RPC lines on stdin and stdout."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from typing import Any, TextIO

from postlake import __version__
from postlake.errors import MailboxError, NotFoundError

#: Protocol versions spoken, the newest first, and the error codes of JSON-RPC.
PROTOCOLS = ("2025-06-18", "2025-03-26", "2024-11-05")
PARSE_ERROR, INVALID_REQUEST, NO_METHOD, INVALID_PARAMS, INTERNAL = -32700, -32600, -32601, -32602, -32603

_TEXT, _INT, _FLAG = {"type": "string"}, {"type": "integer"}, {"type": "boolean"}
#: Name: (what it is for, properties, those required, call).
TOOLS: dict[str, tuple[str, dict, tuple[str, ...], Callable[..., Any]]] = {
    "store_info": ("Path, kind and name of the store, number of folders, relations for sql.", {}, (), lambda box: box.store_info()),
    "list_folders": ("Folders by path with their cached counts.", {"contains": _TEXT}, (), lambda box, contains=None: box.list_folders(contains)["rows"]),
    "search": (
        "Messages by text in subject and sender, folder, time (since included, until not) and attachments; newest first.",
        {"text": _TEXT, "folder": _TEXT, "since": _TEXT, "until": _TEXT, "with_attachments": _FLAG, "limit": _INT}, (), lambda box, **kw: box.search(**kw),
    ),
    "sql": ("One read-only query over folders, messages and ost_attachments(message_nid => ...). Joins and aggregates work.", {"query": _TEXT, "limit": _INT}, ("query",), lambda box, query, limit=None: box.sql(query, limit)),
    "get_message": ("A message with body, recipients and attachment list.", {"nid": _INT, "max_body_chars": _INT}, ("nid",), lambda box, nid, max_body_chars=None: box.get_message(nid, *([] if max_body_chars is None else [max_body_chars]))),
    "list_attachments": ("Attachments of a message, without their content.", {"nid": _INT}, ("nid",), lambda box, nid: box.list_attachments(nid)),
    "read_attachment": (
        "Content of an attachment: text where it is text, else base64.", {"message_nid": _INT, "attachment_nid": _INT, "max_bytes": _INT}, ("message_nid", "attachment_nid"),
        lambda box, message_nid, attachment_nid, max_bytes=None: box.read_attachment(message_nid, attachment_nid, *([] if max_bytes is None else [max_bytes])),
    ),
}


class RpcError(Exception):
    def __init__(self, code: int, text: str):
        super().__init__(text)
        self.code = code


def _listed() -> list[dict]:
    return [{"name": n, "description": about, "inputSchema": {"type": "object", "properties": props, "required": list(needed)}} for n, (about, props, needed, _) in TOOLS.items()]


_PYTHON = {"string": str, "integer": int, "boolean": bool}


def call(box, name: str, args: dict[str, Any]) -> Any:
    """A tool's reply. What the caller got wrong, an unknown message too, is INVALID_PARAMS; the rest is INTERNAL."""
    if name not in TOOLS:
        raise RpcError(INVALID_PARAMS, f"no such tool: {name}")
    _, props, needed, run = TOOLS[name]
    args = {k: v for k, v in args.items() if v is not None}
    for k, v in args.items():
        kind = props.get(k, {}).get("type")
        if kind is None or not isinstance(v, _PYTHON[kind]) or (kind == "integer" and isinstance(v, bool)):
            raise RpcError(INVALID_PARAMS, f"{name} takes no such argument: {k}")
    if missing := [k for k in needed if k not in args]:
        raise RpcError(INVALID_PARAMS, f"{name} needs {', '.join(missing)}")
    try:
        return run(box, **args)
    except NotFoundError as e:
        raise RpcError(INVALID_PARAMS, str(e)) from e
    except MailboxError as e:
        raise RpcError(INVALID_PARAMS if name == "sql" else INTERNAL, str(e)) from e
    except Exception as e:  # noqa: BLE001
        raise RpcError(INTERNAL, str(e).split("\n")[0]) from e


def answer(box, message: Any) -> dict | None:
    """The reply to a request, None to a notification."""
    if not isinstance(message, dict) or message.get("jsonrpc") != "2.0" or not isinstance(message.get("method"), str):
        return {"jsonrpc": "2.0", "id": None, "error": {"code": INVALID_REQUEST, "message": "no JSON-RPC 2.0 request"}}
    method, params, number = message["method"], message.get("params") or {}, message.get("id")
    try:
        if method == "initialize":
            asked = params.get("protocolVersion")
            result: Any = {"protocolVersion": asked if asked in PROTOCOLS else PROTOCOLS[0], "capabilities": {"tools": {}}, "serverInfo": {"name": "postlake", "version": __version__}}
        elif method == "ping":
            result = {}
        elif method == "tools/list":
            result = {"tools": _listed()}
        elif method == "tools/call":
            reply = call(box, params.get("name", ""), params.get("arguments") or {})
            text = json.dumps(reply, ensure_ascii=False)
            result = {"content": [{"type": "text", "text": text}], "structuredContent": reply if isinstance(reply, dict) else {"rows": reply}, "isError": False}
        elif method.startswith("notifications/"):
            return None
        else:
            raise RpcError(NO_METHOD, f"no such method: {method}")
    except RpcError as e:
        return None if "id" not in message else {"jsonrpc": "2.0", "id": number, "error": {"code": e.code, "message": str(e)}}
    return None if "id" not in message else {"jsonrpc": "2.0", "id": number, "result": result}


def serve(box, lines: TextIO, out: TextIO) -> None:
    """A line in, a line out, until the input ends; nothing else is written to ``out``."""
    for line in lines:
        if not line.strip():
            continue
        try:
            reply = answer(box, json.loads(line))
        except ValueError:
            reply = {"jsonrpc": "2.0", "id": None, "error": {"code": PARSE_ERROR, "message": "no JSON"}}
        if reply is not None:
            out.write(json.dumps(reply, ensure_ascii=False) + "\n")
            out.flush()


def main(argv: list[str] | None = None) -> int:
    from postlake.session import session
    from postlake.sources.discover import open_store

    args = sys.argv[1:] if argv is None else argv
    out, sys.stdout = sys.stdout, sys.stderr
    serve(open_store(session(), args[0] if args else None), sys.stdin, out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
