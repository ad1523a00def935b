"""URL functions as Column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rewrites that make addresses of one page equal, in order (fixed values).
CLEANING = (
    (r"^http://\s*", "https://"), (r"\r?\n", ""), (r"\s*#.*", ""), (r"(?<=\.pdf)&.*", ""), (r"(?<=asp)\?.*", ""), (r"\.un\.org/../", ".un.org/"),
    (r"/[^./]*?/../", "/"), (r"\s*[|/?]$", ""), (r"https://(.*?\.un\.org)//\1/", "https://$1/"), (" ", "%20"), (r"(.*ldcportal/content/[^?\n]*)\?.*", "$1"), (r"\t", ""),
)
#: Extensions of media files, and what an address may not contain (fixed values).
MEDIA = (
    "avi", "wmv", "mpeg", "mp4", "mov", "mkv", "flv", "f4v", "m4v", "rmvb", "rm", "3gp", "dat", "ts", "mts", "vob", "bmp", "jpg", "png", "tiff", "gif", "pcx", "tga", "exif", "fpx", "svg",
    "psd", "cdr", "pcd", "dxf", "ufo", "eps", "ai", "raw", "wmf", "mp3", "aiff", "aac",
)
EXCLUDED = ("search?", "download?", "subscribe?", "system/403?", "sustainabledevelopment.un.org/", "https://www.un.org/unispal/documents/?")
#: How file names write characters that they can't hold (fixed values).
ESCAPES = (
    ("?", "_QMARK_"), (":", "_COLON_"), ("|", "_PIPE_"), ("/", "_SLASH_"), ("*", "_STAR_"), ('"', "_QT_"), ("\\", "_BS_"), ("<", "_LT_"), (">", "_GT_"),
)


def clean_url(url: Column) -> Column:
    for pattern, put in CLEANING:
        url = F.regexp_replace(url, pattern, put)
    return url


def is_media(url: Column) -> Column:
    return (F.instr(url, ".") > 1) & F.lower(F.regexp_replace(url, r"^.*\.", "")).isin(*MEDIA)


def is_excluded(url: Column) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.contains(url, F.lit(x)) for x in EXCLUDED])


def links(html: Column) -> Column:
    """Targets of anchors in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'<a\s[^>]*?href="([^"#]+)"'), F.lit(1)))


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)


def absolute(link: Column, base: Column) -> Column:
    """A link of a page as a whole address: schemes stay, rooted paths go to the host, others to the page's folder."""
    root = F.regexp_extract(base, r"^([a-z]+://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<![:/])/[^/]*$", "")
    return (
        F.when(link.rlike(r"^[a-z]+://"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-z]+:)", 1), link))
        .when(link.startswith("/"), F.concat(root, link)).otherwise(F.concat(folder, F.lit("/"), link))
    )


def in_language(url: Column, lang: str) -> Column:
    """Addresses whose path begins with the language's folder."""
    return F.coalesce(url.rlike(rf"^https?://[^/]+/{lang}/"), F.lit(False))


#: Extensions of the documents to fetch (fixed values).
DOCUMENTS = (".wpf", ".doc")


def is_document(number: Column, url: Column) -> Column:
    """A numbered document in a format that can be converted."""
    return number.isNotNull() & extension(url).isin(*DOCUMENTS)


def path_parts(url: Column) -> Column:
    path = F.url_decode(F.regexp_replace(F.regexp_extract(url, r"^[a-z]+://[^/]+(/[^?#]*)", 1), r"\+", "%2B"))
    return F.filter(F.split(path, "/"), lambda p: p != "")


def escape_name(name: Column) -> Column:
    for char, put in ESCAPES:
        name = F.replace(name, F.lit(char), F.lit(put))
    return name


def document_name(lang: Column, url: Column) -> Column:
    return F.translate(F.concat(lang, F.lit("-"), F.right(url, F.lit(12))), "/\\", "__")


def language_of_title(title: Column) -> Column:
    """NULL for a title of another form."""
    return F.nullif(F.regexp_extract(title, r"Open(.+?)WordDocument", 1), F.lit(""))


def swap_extension(name: Column, put: str) -> Column:
    return F.regexp_replace(name, r"\.\w+$", put)


def extension(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(\.[^./]*)$", 1))


def masquerades_as_document(content: Column) -> Column:
    """An HTML page where a document should be: all three marks, in either case."""
    small = F.lower(content)
    return F.contains(small, F.lit("<!doctype html public ")) & F.contains(small, F.lit("<html>")) & F.contains(small, F.lit("<head>"))
