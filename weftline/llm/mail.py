"""What a mail's author wrote: transfer encodings undone, headers, greeting, signature, disclaimer and quotes left out."""

from __future__ import annotations

import base64
import binascii
import html
import quopri
import re

HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:(?:\s|$)")
BOUNDARY = re.compile(r"boundary\s*=\s*(?:\"([^\"]+)\"|([^\s;]+))", re.I)
CHARSET = re.compile(r"charset\s*=\s*\"?([^\s;\"]+)", re.I)
TAG = re.compile(r"<[^<>]*>")
BREAK = re.compile(r"<\s*(?:br|/p|/div|/li|/tr|/h[1-6]|/table|hr)\b[^<>]*>", re.I)
QUOTE_HTML = re.compile(r"<\s*blockquote\b.*?(?:<\s*/\s*blockquote\s*>|\Z)", re.I | re.S)
UNSEEN_HTML = re.compile(r"<\s*(style|script|head|title)\b.*?<\s*/\s*\1\s*>|<!--.*?-->", re.I | re.S)
LINK = re.compile(r"(?:https?://|www\.)\S+", re.I)
#: How clients introduce a quoted or forwarded message.
QUOTE_BEGINS = re.compile(
    r"^\s*(?:-{2,}\s*(?:original|forwarded|urspr|weitergeleitet|mensaje|message d|message transf|begin forwarded)|begin forwarded message"
    r"|(?:on|am|le|el|il|op|em)\b.{5,200}(?:wrote|schrieb|écrit|escribió|scrisse|ha scritto|schreef|escreveu).{0,80}:?\s*$"
    r"|.{3,120}\b(?:wrote|schrieb|a écrit|escribió)\b(?:\s+(?:on|am|le|el)\b.{0,80})?\s*:\s*$)",
    re.I,
)
QUOTED_HEADER = re.compile(r"^\s*(?:from|von|de|sent|gesendet|envoyé|enviado|date|datum|fecha|subject|betreff|objet|asunto|to|an|à|para)\s*:\s", re.I)
#: Closing lines of a mail.
CLOSINGS = re.compile(
    r"^(?:(?:kind|best|warm|many)\s+)?(?:regards|wishes)|^(?:thanks|thank you|many thanks|cheers|sincerely|yours|yours sincerely|yours faithfully|best|greetings|see you)(?:\s+(?:and regards|in advance|again|a lot))?$"
    r"|^(?:mit\s+)?(?:freundlichen?|viele|beste|liebe|herzliche|schöne)\s+(?:grüße|grüßen|gruesse|gruß)|^(?:mfg|lg|vg)$"
    r"|^(?:bien\s+)?cordialement|^salutations|^bien à vous|^sincères salutations|^merci$|^à bientôt"
    r"|^(?:un\s+(?:cordial\s+)?saludo|saludos(?:\s+cordiales)?|atentamente|gracias|cordialmente)$",
    re.I,
)
#: Words that open a mail.
GREETING = re.compile(r"^(?:hi|hello|dear|morning|good (?:morning|afternoon|evening)|hey|hallo|guten (?:tag|morgen)|liebe[rs]?|sehr geehrte|moin|bonjour|bonsoir|salut|cher|chère|chers|hola|buenos días|buenas tardes|estimad[oa]s?|querid[oa]s?)\b.{0,60}[,:!.]?$", re.I)
#: Stems that confidentiality and liability notes are made of, in several languages; a note has several of them.
NOTE_STEMS = re.compile(
    r"\b(?:confiden|vertraulich|privileg|address(?:ee|ed)|adressat|recipient|destina|empfänger|intended|bestimmt|unauthori|liab|haft|responsab|übernimmt|disclos|delete|lösch|supprim|elimin|error\b|mistake|irrt|erreur|opinion|author\b|sender|absender|expéditeur|remitente|print(?:ing|ed)\b|ausdruck|imprim|registered|sitz\b|gesellschaft|meant only|dirigido)"
)


def is_note(line: str) -> bool:
    """Whether a line is a confidentiality or liability note: three of their stems, or two in a short line."""
    return len(line) > 20 and len(set(NOTE_STEMS.findall(line.lower()))) >= (2 if len(line) < 120 else 3)


def split_head(text: str) -> tuple[dict[str, str], str]:
    """A part's header fields (lower case) and its body."""
    lines = text.split("\n")
    fields: dict[str, str] = {}
    last = ""
    for i, line in enumerate(lines):
        if not line.strip():
            return fields, "\n".join(lines[i + 1 :])
        if line[0] in " \t" and last:
            fields[last] += " " + line.strip()
        elif HEADER.match(line):
            name, _, value = line.partition(":")
            last = name.lower()
            fields[last] = value.strip()
        elif i == 0:
            return {}, text
        else:
            return fields, "\n".join(lines[i:])
    return fields, ""


def undo(body: str, encoding: str, charset: str) -> str:
    """A body without its transfer encoding; what can't be decoded stays as it is."""
    try:
        if encoding == "base64":
            compact = re.sub(r"[^A-Za-z0-9+/]", "", body)
            raw = base64.b64decode(compact[: len(compact) // 4 * 4] if len(compact) % 4 == 1 else compact + "=" * (-len(compact) % 4))
        elif encoding == "quoted-printable":
            raw = quopri.decodestring(body.encode("utf-8", "replace"))
        else:
            return body
    except (ValueError, binascii.Error):
        return body
    for name in (charset or "utf-8", "utf-8", "cp1252"):
        try:
            return raw.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return raw.decode("latin-1")


def from_html(text: str) -> str:
    text = UNSEEN_HTML.sub(" ", text)
    text = QUOTE_HTML.sub("\n", text)
    text = re.sub(r"<a\b[^<>]*href\s*=\s*[\"']?([^\"'\s>]+)[^<>]*>", r" \1 ", text, flags=re.I)
    text = BREAK.sub("\n", text.replace("\n", " "))
    return html.unescape(TAG.sub(" ", text))


#: Parts within parts are looked into down to this depth; what lies deeper is left out, as no mail reader shows it.
MOST_DEEP = 100


def readable(text: str, depth: int = 0) -> str:
    """The text that a reader of the message sees: of alternatives the plain one, without attachments."""
    if depth > MOST_DEEP:
        return ""
    fields, body = split_head(text)
    kind = fields.get("content-type", "text/plain").lower()
    if fields.get("content-disposition", "").lower().startswith("attachment"):
        return ""
    if kind.startswith("multipart/"):
        m = BOUNDARY.search(fields["content-type"])
        mark = "--" + (m[1] or m[2]) if m else None
        if mark and mark in body:
            parts, current = [], None
            for line in body.split("\n"):
                if line.startswith(mark) and line.rstrip() in (mark, mark + "--"):
                    if current is not None:
                        parts.append("\n".join(current))
                    current = None if line.rstrip() == mark + "--" else []
                elif current is not None:
                    current.append(line)
            if current is not None:
                parts.append("\n".join(current))
            if kind.startswith("multipart/alternative"):
                plain = [p for p in parts if split_head(p)[0].get("content-type", "text/plain").lower().startswith("text/plain")]
                for p in plain or parts:
                    seen = readable(p, depth + 1)
                    if seen.strip():
                        return seen
                parts = [p for p in parts if p not in plain]
            return "\n".join(filter(None, (readable(p, depth + 1) for p in parts)))
    elif not kind.startswith(("text/", "multipart/", "message/")):
        return "" if depth else body
    if kind.startswith("message/"):
        return ""  # a message of somebody else
    m = CHARSET.search(fields.get("content-type", ""))
    body = undo(body, fields.get("content-transfer-encoding", "").lower().strip(), m[1] if m else "")
    return from_html(body) if kind.startswith("text/html") or re.match(r"\s*<(?:!doctype|html)\b", body, re.I) else body


def own_content(text: str | None) -> str:
    """The author's own lines of a raw message; empty for a null or blank text."""
    if not text or not text.strip():
        return ""
    body = readable(text.replace("\r\n", "\n").replace("\r", "\n").lstrip("\n"))
    kept: list[str] = []
    lines = body.replace("\r\n", "\n").split("\n")
    for i, line in enumerate(lines):
        bare = line.strip()
        if bare.startswith(">"):
            continue
        if QUOTE_BEGINS.match(bare) and not LINK.search(bare):
            if next((x for x in lines[i + 1 :] if x.strip()), "").lstrip().startswith(">"):
                continue  # the quote is marked line by line, and an answer may stand below it
            break
        if QUOTED_HEADER.match(bare) and sum(bool(QUOTED_HEADER.match(x)) for x in lines[i : i + 4]) >= 2:
            break
        if line.rstrip("\n") in ("-- ", "--") or re.fullmatch(r"[_=*-]{5,}", bare):
            if any(k.strip() for k in kept):
                break
            continue
        if CLOSINGS.search(bare.rstrip(",.! ")) and len(bare) < 40 and any(k.strip() for k in kept):
            break
        kept.append(bare)
    out = [k for k in kept if not (is_note(k) and not LINK.search(k))]
    for i, k in enumerate(out):
        if k:
            if GREETING.match(k):
                out[i] = ""
            break
    return "\n".join(out).strip()
