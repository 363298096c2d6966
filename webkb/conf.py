"""Job configuration and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the crawl settings being reproduced)
# ---------------------------------------------------------------------------
ELEMENT_TYPES = ("URL", "PDF", "Image")
RETRY_TIMES = 3
RETRY_HTTP_CODES = (500, 502, 503, 504, 408, 429)
CACHE_EXPIRATION_SECS = 86400
CACHE_IGNORE_HTTP_CODES = (503, 504, 505, 500, 400, 401, 402, 403, 404)
MAX_REQUESTS_PER_DOMAIN = 1000
DEFAULT_DEPTH = 6
JOB_ID_FORMAT = "yyyyMMdd_HHmmss"
DEFAULT_IMAGE_CONTENT_TYPE = "image/jpeg"
DEFAULT_IMAGE_EXTENSION = ".jpeg"
REMOVE_SELECTORS = ("footer", "header")
PDF_METHODS = ("auto", "ocr", "txt")

# Schemes a followed link may use, and extensions the default link
# extractor of the crawling library denies (its public default list).
FOLLOW_SCHEMES = ("http", "https", "ftp", "file")
DENIED_EXTENSIONS = (
    # archives
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    # images
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif",
    "tiff", "ai", "drw", "dxf", "eps", "ps", "svg", "cdr", "ico", "webp",
    # audio
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    # video
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv",
    "m4a", "m4v", "flv", "webm",
    # office suites
    "xls", "xlsx", "ppt", "pptx", "pps", "doc", "docx", "odt", "ods", "odg", "odp",
    # other
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk", "jar", "sh", "rb",
    "js", "hta", "bat", "cpl", "msi", "msp", "py",
)

# Extension -> mime type used when no explicit content type is given
# (standard mime table entries for the extensions this job writes or meets,
# plus the two Markdown entries the upload helper registers).
MIME_BY_EXTENSION = {
    "html": "text/html",
    "htm": "text/html",
    "md": "text/markdown",
    "markdown": "text/markdown",
    "pdf": "application/pdf",
    "jpeg": "image/jpeg",
    "jpg": "image/jpeg",
    "jpe": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "svg": "image/svg+xml",
    "webp": "image/webp",
    "ico": "image/vnd.microsoft.icon",
    "bmp": "image/bmp",
    "tif": "image/tiff",
    "tiff": "image/tiff",
    "txt": "text/plain",
    "css": "text/css",
    "csv": "text/csv",
    "js": "text/javascript",
    "json": "application/json",
    "xml": "text/xml",
    "zip": "application/zip",
}

# Order of kinds inside one page (page first, then PDFs, then images).
KIND_RANK = {"URL": 0, "PDF": 1, "Image": 2}

# BM25 parameters.
BM25_K1 = 1.2
BM25_B = 0.75


@dataclass
class JobConf:
    """Everything one knowledge-base build needs."""

    seeds: list[str] = field(default_factory=list)
    job_ts: str = "2024-01-02 03:04:05"
    max_depth: int = DEFAULT_DEPTH
    follow: bool = True
    parent_as_url: bool = False
    remove_selectors: tuple[str, ...] = REMOVE_SELECTORS
    retain_images: bool = False
    pdf_method: str = "auto"
    max_requests_per_domain: int | None = None
    user_agent: str = "*"
    partitions: int | None = None
    cache_ttl_secs: int = CACHE_EXPIRATION_SECS
    extractor_version: str | None = None
