"""WARC derivatives: each response becomes a metadata record and a plain-text conversion record that refer to it.

A record is a row: type, record_id, refers_to, target_uri, date, content_type, source_headers (the HTTP header lines kept as
they came), payload_digest (of the response's payload, in all three), block and block_digest. Identifiers are name-based on
the content, so a repeated task gives the same ones. Records are written to .warc.gz files, one gzip member each, and read again
record by record.

Defined results: a null or broken HTTP block has no headers and the whole block as payload; null payload counts as empty; chunked
transfer and gzip or deflate content encodings are undone before conversion (digests are of the payload as it came), a broken or
unknown encoding gives an empty conversion; bytes that are no UTF-8 (or the declared charset) are replaced; other media types than
HTML and plain text give an empty conversion; repeated rows give equal records; an empty table gives an empty result; further
columns are ignored. Of markup, an unclosed comment or script is taken for a tag without content, and an unclosed tag for text.
A file's broken part is a row of its own whose error says why, and reading goes on at the next record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORD = "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, source_headers string, payload_digest string, block binary, block_digest string"
NAMES = [f.split()[0] for f in RECORD.split(", ")]
#: Elements that are left out with what they hold, and those that end a line (fixed values).
DROPPED = ("script", "style", "noscript", "template", "head")
BREAKS = frozenset(
    "p div br li ul ol tr table h1 h2 h3 h4 h5 h6 section article header footer nav main aside blockquote pre dd dt dl form hr figure figcaption option body html".split()
)
MARK = re.compile(r"<!--|</?([a-zA-Z][a-zA-Z0-9]*)|<[!?]")
#: The rest of a tag: quoted values may hold what would end it.
TAG_REST = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
CLOSERS = {t: re.compile(rf"</{t}\b[^>]*>", re.IGNORECASE) for t in (*DROPPED, "title")}
TITLE = re.compile(r"<title\b[^>]*>", re.IGNORECASE)
HREF = re.compile(r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)')""", re.IGNORECASE)
BLANKS, LINES = re.compile(r"[ \t\r\f\v\xa0]+"), re.compile(r" ?\n[ \n]*")


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(chr(0).join(parts).encode()).digest()[:16], version=5)}>"


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Header lines as they came, fields by small name, payload."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", {}, block
    lines = head.decode("latin-1")
    return lines, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.split("\r\n")[1:])}, payload


def read_markup(markup: str) -> tuple[str, str, list[str]]:
    """Plain text, title and link targets, in one pass: what was once looked for in vain isn't looked for again, so time is linear."""
    out, links, title, at = [], [], None, 0
    missing: set[str] = set()

    def closed(what: str, pattern: re.Pattern, start: int) -> re.Match | None:
        found = None if what in missing else pattern.search(markup, start)
        if found is None:
            missing.add(what)
        return found

    while mark := MARK.search(markup, at):
        out.append(markup[at : mark.start()])
        name = (mark[1] or "").lower()
        if mark[0] == "<!--":
            end = -1 if "-->" in missing else markup.find("-->", mark.end())
            if end >= 0:
                out.append(" ")
                at = end + 3
                continue
            missing.add("-->")
        # Unclosed quotes up to the end of the text: tags are then taken to end at their first >.
        rest = None if '"' in missing else TAG_REST.match(markup, mark.end())
        if rest is None:
            missing.add('"')
            end = -1 if ">" in missing else markup.find(">", mark.end())
            if end < 0:
                out.append(markup[mark.start() :])
                at = len(markup)
                break
            end += 1
        else:
            end = rest.end()
        opens = mark[0][1] != "/"
        if title is None and name == "title" and opens:
            closer = closed("title", CLOSERS["title"], end)
            title = markup[end : closer.start()] if closer else None
        if opens and name in DROPPED and (closer := closed(name, CLOSERS[name], end)):
            if title is None and name == "head" and (start := TITLE.search(markup, end, closer.start())) and (last := CLOSERS["title"].search(markup, start.end(), closer.start())):
                title = markup[start.end() : last.start()]
            out.append(" ")
            at = closer.end()
            continue
        if opens and name == "a" and (href := HREF.search(markup, mark.end(), end)):
            links.append(html.unescape(href[1] if href[1] is not None else href[2]))
        out.append("\n" if name in BREAKS else "")
        at = end
    text = html.unescape("".join([*out, markup[at:]]))
    return LINES.sub("\n", BLANKS.sub(" ", text)).strip(" \n"), html.unescape(title or "").strip(), links


def plain_text(markup: str) -> str:
    return read_markup(markup)[0]


def unchunked(payload: bytes) -> bytes:
    """The body of a chunked transfer; ValueError for a broken one."""
    out, at = [], 0
    while True:
        end = payload.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size")
        size = int(payload[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if size < 0 or end + 2 + size > len(payload):
            raise ValueError("chunk cut short")
        out.append(payload[end + 2 : end + 2 + size])
        at = end + 4 + size


def body_of(fields: dict[str, str], payload: bytes) -> bytes | None:
    """The payload without transfer and content encodings; None where one is broken or unknown."""
    try:
        if "chunked" in fields.get("transfer-encoding", "").lower():
            payload = unchunked(payload)
        for coding in reversed([c.strip().lower() for c in fields.get("content-encoding", "").split(",")]):
            if coding in ("gzip", "x-gzip"):
                payload = gzip.decompress(payload)
            elif coding == "deflate":
                payload = zlib.decompress(payload, zlib.MAX_WBITS if payload[:1] == b"\x78" else -zlib.MAX_WBITS)
            elif coding not in ("", "identity"):
                return None
    except (ValueError, OSError, EOFError, zlib.error):
        return None
    return payload


def decoded(payload: bytes, content_type: str) -> str:
    charset = re.search(r"charset=[\"']?([\w.:-]+)", content_type, re.IGNORECASE)
    try:
        return payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derivatives(of_id: str | None, uri: str | None, date: str | None, block: bytes | None) -> list[dict]:
    """The metadata and the conversion record of one response."""
    lines, fields, payload = split_http(block or b"")
    kind = fields.get("content-type", "text/html")
    sum_ = digest(payload)
    body = body_of(fields, payload)
    markup = decoded(body, kind) if body is not None and re.match(r"\s*(text/html|application/xhtml|text/plain)", kind, re.IGNORECASE) else ""
    text, title, links = (markup.strip(), "", []) if kind.lower().lstrip().startswith("text/plain") else read_markup(markup)
    about = {"title": title, "content-type": kind, "payload-length": len(payload), "text-length": len(text), "outlinks": links}
    blocks = (("metadata", "application/json", json.dumps(about, ensure_ascii=False, sort_keys=True).encode()), ("conversion", "text/plain; charset=utf-8", text.encode()))
    own = record_id(of_id or "", "metadata", sum_), record_id(of_id or "", "conversion", sum_)
    return [
        {"warc_type": t, "record_id": own[i], "refers_to": of_id, "target_uri": uri, "date": date, "content_type": c, "source_headers": lines, "payload_digest": sum_, "block": b, "block_digest": digest(b)}
        for i, (t, c, b) in enumerate(blocks)
    ]


def derive(responses: DataFrame, key: str) -> DataFrame:
    """key and two records for each row of responses(key, record_id, target_uri, date, block)."""
    kind = responses.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {RECORD}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(c).to_pylist() for c in ("record_id", "target_uri", "date", "block")]
            rows = [d for r in zip(*given) for d in derivatives(*r)]
            keys = [k for k in batch.column(key).to_pylist() for _ in range(2)]
            types = {"block": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(key).type), *[pa.array([r[c] for r in rows], types.get(c, pa.string())) for c in NAMES]], names=[key, *NAMES])

    return responses.select(key, "record_id", "target_uri", "date", "block").mapInArrow(run, schema)


def responses_of_pages(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Responses as they would stand in an archive, from raw pages (page_id, url, html)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    head: Column = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    name = F.sha2(F.concat_ws("\0", F.col("page_id").cast("string"), F.col("url")), 256)
    urn = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.substring(name, 1, 32), r"(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))
    return pages.select("page_id", urn.alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.concat(head.cast("binary"), body).alias("block"))


#: Fields of a written record: WARC's name, ours.
FIELDS = (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Payload-Digest", "payload_digest"), ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"))


def written(row: dict) -> bytes:
    """One record in WARC/1.1; the source's header lines go into a field, as JSON."""
    fields = [(n, row[c]) for n, c in FIELDS if row.get(c) is not None]
    if row.get("source_headers"):
        fields.append(("X-Source-Headers", json.dumps(row["source_headers"])))
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in [*fields, ("Content-Length", len(row["block"]))]) + "\r\n"
    return head.encode() + row["block"] + b"\r\n\r\n"


def inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes | str]:
    """A file's bytes in steps, gzip members undone one after another; a string says what was broken, and the next member follows."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + step] for i in range(0, len(content), step))
        return
    at = 0
    while 0 <= at < len(content):
        member, fed = zlib.decompressobj(wbits=31), at
        try:
            while not member.eof and fed < len(content):
                given = member.unconsumed_tail or content[fed : fed + step]
                if not member.unconsumed_tail:
                    fed += len(given)
                if out := member.decompress(given, step):
                    yield out
            if not member.eof:
                yield "gzip member cut short"
                return
            at = fed - len(member.unused_data)
            if at < len(content) and content[at : at + 2] != b"\x1f\x8b":
                yield "bytes that are no gzip member"
                at = content.find(b"\x1f\x8b\x08", at)
        except zlib.error as e:
            yield f"gzip: {e}"
            at = content.find(b"\x1f\x8b\x08", at + 2)


#: A record's header is no longer than this; its block is as long as it says.
MOST_HEADER = 1 << 20
VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")


def parsed(steps: Iterator[bytes | str]) -> Iterator[dict]:
    """Records one after another; no more than one record and one step are held. A broken stretch is a row with an error."""
    buffer, ours = bytearray(), {n.lower(): c for n, c in FIELDS}
    steps = iter(steps)
    broken = lambda why: dict.fromkeys([*NAMES, "error"]) | {"error": why}
    complaint: list[str] = []

    def more() -> bool:
        for step in steps:
            if isinstance(step, str):
                complaint.append(step)
                return False
            buffer.extend(step)
            return True
        return False

    ended = False
    while True:
        while (start := VERSION.search(buffer)) is None and not ended:
            ended = not more()
        if start is None:
            if buffer.strip():
                yield broken("no record")
        else:
            if buffer[: start.start()].strip():
                yield broken("bytes between records")
            del buffer[: start.start()]
            while (end := buffer.find(b"\r\n\r\n")) < 0 and len(buffer) < MOST_HEADER and not ended:
                ended = not more()
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in bytes(buffer[: max(end, 0)]).decode("utf-8", "replace").split("\r\n")[1:])}
            length = fields.get("content-length", "")
            if end < 0 or not (length.isascii() and length.isdigit()):
                yield broken("header without an end" if end < 0 else "no Content-Length")
                del buffer[: start.end() - start.start()]
                continue
            while len(buffer) < end + 4 + int(length) and not ended:
                ended = not more()
            if len(buffer) < end + 4 + int(length):
                yield broken("block cut short")
                del buffer[: start.end() - start.start()]
            else:
                row = dict.fromkeys([*NAMES, "error"]) | {c: fields[n] for n, c in ours.items() if n in fields} | {"block": bytes(buffer[end + 4 : end + 4 + int(length)])}
                try:
                    row["source_headers"] = json.loads(fields["x-source-headers"]) if "x-source-headers" in fields else ""
                except ValueError:
                    row["error"] = "source headers that are no JSON"
                yield row
                del buffer[: end + 4 + int(length)]
            if buffer.strip() or not ended:
                continue
        if complaint:
            yield broken(complaint.pop())
            ended = False
            buffer.clear()
            continue
        return


def to_files(records: DataFrame) -> DataFrame:
    """One gzip member for each record, ready to be joined to .warc.gz files: key columns dropped, member binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gzip.compress(written(r), mtime=0) for r in batch.to_pylist()], pa.binary())], names=["member"])

    return records.select(*NAMES).mapInArrow(run, "member binary")


def write_files(records: DataFrame, folder: str) -> DataFrame:
    """Writes records as folder/part-NNNNN.warc.gz, one file for each partition with rows; returns file and records.

    folder: an address that every executor reaches. A file is written under a name of its attempt and then renamed, so a
    repeated task replaces its own file and nobody sees half of one. The work is done when the result is computed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task, count, out, system = TaskContext.get(), 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
                    system.create_dir(root, recursive=True)
                    final = f"{root}/part-{task.partitionId():05d}.warc.gz"
                    own = f"{root}/_attempt-{task.taskAttemptId()}"
                    out = system.open_output_stream(own, compression=None)
                out.write(gzip.compress(written(row), mtime=0))
                count += 1
        if out is not None:
            out.close()
            system.move(own, final)
            yield pa.RecordBatch.from_arrays([pa.array([final]), pa.array([count], pa.int64())], names=["file", "records"])

    return records.select(*NAMES).mapInArrow(run, "file string, records bigint")


def read_files(files: DataFrame, batch_bytes: int = 16 << 20) -> DataFrame:
    """Records, with error, of files(content), plain or gzip, as spark.read.format('binaryFile') gives them; rows leave in batches of so many bytes."""
    names = [*NAMES, "error"]

    def rows_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.binary() if c == "block" else pa.string()) for c in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for row in parsed(inflated(content.as_py() or b"")):
                    rows.append(row)
                    size += len(row["block"] or b"")
                    if size >= batch_bytes or len(rows) >= 1000:
                        yield rows_of(rows)
                        rows, size = [], 0
                if rows:
                    yield rows_of(rows)

    return files.select("content").mapInArrow(run, f"{RECORD}, error string")


def responses(records: DataFrame) -> DataFrame:
    """The HTTP responses among records, as derive takes them, by key response: warcinfo, requests and the like are no pages."""
    whole = (F.col("warc_type") == "response") & F.col("error").isNull()
    http = F.coalesce(F.col("content_type"), F.lit("application/http")).rlike(r"(?i)^\s*application/http")
    return records.where(whole & http).select(F.col("record_id").alias("response"), "record_id", "target_uri", "date", "block")
