"""Payload expressions: media types, data URLs, requests, responses, headers."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Types by lower-case file extension. No table of the running Python, which
# changes between versions.
MEDIA_TYPES = {
    "3gp": "audio/3gpp",
    "3gpp": "audio/3gpp",
    "3g2": "audio/3gpp2",
    "3gpp2": "audio/3gpp2",
    "aac": "audio/aac",
    "adts": "audio/aac",
    "aif": "audio/x-aiff",
    "aifc": "audio/x-aiff",
    "aiff": "audio/x-aiff",
    "ass": "audio/aac",
    "au": "audio/basic",
    "avi": "video/x-msvideo",
    "bin": "application/octet-stream",
    "bmp": "image/bmp",
    "css": "text/css",
    "csv": "text/csv",
    "flac": "audio/flac",
    "gif": "image/gif",
    "htm": "text/html",
    "html": "text/html",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "json": "application/json",
    "loas": "audio/aac",
    "m4a": "audio/mp4",
    "mov": "video/quicktime",
    "mp2": "audio/mpeg",
    "mp3": "audio/mpeg",
    "mp4": "video/mp4",
    "mpeg": "video/mpeg",
    "mpg": "video/mpeg",
    "ogg": "audio/ogg",
    "opus": "audio/ogg",
    "pdf": "application/pdf",
    "png": "image/png",
    "py": "text/x-python",
    "ra": "audio/x-pn-realaudio",
    "sh": "application/x-sh",
    "snd": "audio/basic",
    "tar": "application/x-tar",
    "txt": "text/plain",
    "wav": "audio/x-wav",
    "weba": "audio/webm",
    "webm": "video/webm",
    "xml": "text/xml",
    "zip": "application/zip",
}
FALLBACK_TYPE = "audio/wav"


def mime_by_extension(src: Column) -> Column:
    """Type by the last suffix of a path; commands and unknown suffixes are WAV."""
    # one text literal, folded to a constant map when the query is planned
    table = F.from_json(F.lit(json.dumps(MEDIA_TYPES)), "map<string, string>")
    unpacked = F.regexp_replace(src, r"\.(gz|Z|bz2|xz|br)$", "")
    suffix = F.lower(F.regexp_extract(unpacked, r"[^/.][^/]*\.([^./]+)$", 1))
    known = F.try_element_at(table, suffix)
    return F.when(F.endswith(src, F.lit("|")), FALLBACK_TYPE).otherwise(
        F.coalesce(known, F.lit(FALLBACK_TYPE))
    )


# Leading bytes of media files.
FLAC, ID3, MPEG_FRAME, OGG = b"fLaC", b"ID3", b"\xff\xfb", b"OggS"
RIFF, WAVE, BOX = b"RIFF", b"WAVE", b"ftyp"


def mime_by_magic(content: Column, strict: bool = True) -> Column:
    """Type by leading bytes. `strict=False` also finds the box type at offset 4."""
    def starts(signature: bytes, at: int = 1) -> Column:
        return F.substring(content, at, len(signature)) == F.lit(signature)

    mp4 = starts(BOX)
    if not strict:
        mp4 = mp4 | starts(BOX, 5)
    return (
        F.when(starts(FLAC), "audio/flac")
        .when(starts(ID3) | starts(MPEG_FRAME), "audio/mpeg")
        .when(starts(OGG), "audio/ogg")
        .when(starts(RIFF) & starts(WAVE, 9), "audio/wav")
        .when(mp4, "audio/mp4")
        .otherwise(FALLBACK_TYPE)
    )


def base64_plain(content: Column) -> Column:
    """Base64 without line breaks, whatever the session's chunking setting is."""
    return F.replace(F.base64(content), F.lit("\r\n"))


def data_url(content: Column, mime: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), base64_plain(content))


def build_request(
    url: Column, model: str, temperature: float = 0.2, max_tokens: int = 400
) -> Column:
    """Chat request of one user message with one audio part."""
    part = F.struct(F.lit("audio_url").alias("type"), F.struct(url.alias("url")).alias("audio_url"))
    message = F.struct(F.lit("user").alias("role"), F.array(part).alias("content"))
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.array(message).alias("messages"),
            F.lit(float(temperature)).alias("temperature"),
            F.lit(int(max_tokens)).alias("max_tokens"),
        )
    )


_RESPONSE = "choices array<struct<message: struct<content: string>>>, usage string"


def parse_response(body: Column) -> Column:
    """Struct (content, usage); content is null where the path is missing."""
    parsed = F.from_json(body, _RESPONSE)
    return F.struct(
        F.get(parsed["choices"], F.lit(0))["message"]["content"].alias("content"),
        F.coalesce(parsed["usage"], F.lit("{}")).alias("usage"),
    )


def flac_stream_info(head: Column) -> Column:
    """Struct (sample_rate, channels, samples) from bytes 19-26 of a FLAC stream.

    The 64 bits hold rate (20), channels-1 (3), sample size-1 (5), samples (36).
    """
    word = F.hex(F.substring(head, 19, 8))

    def number(digits: Column) -> Column:
        return F.conv(digits, 16, 10).cast("bigint")

    rate = number(F.substring(word, 1, 5))
    flags = number(F.substring(word, 6, 1))
    samples = number(F.substring(word, 8, 9))
    whole = F.octet_length(head) >= 26
    return F.struct(
        F.when(whole, rate).alias("sample_rate"),
        F.when(whole, F.shiftright(flags, 1) + 1).alias("channels"),
        F.when(whole, samples).alias("samples"),
    )
