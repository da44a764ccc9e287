"""Fixed values that results depend on."""

# Parts of a link by which it is not an article's.
IGNORED_PARTS = (
    "pageid/", "pgrid/", "categoryid/", "tagid/", "authorid/", "returnurl=", "login", "register", "facebook.com",
    "twitter.com", "instagram.com", "linkedin.com", "youtube.com", "t.me", "#", "javascript:", "mailto:", "tel:",
)
# Words in a heading that is not a page's title.
NOT_A_TITLE = ("court", "search", "menu", "login")
# Parts of the class of an article's heading, of a date, of a box of articles.
HEADING_CLASSES = ("title", "head")
DATE_CLASSES = ("date", "publish", "time")
BOX_CLASSES = ("edn_", "article", "news_item")
# Texts of a link that say nothing.
GENERIC_TEXTS = ("read more", "more", "detail", "view", "...")
# Fixed value: all white space of Unicode, as a class that Java's and RE2's expressions read alike.
SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# What a file name may not hold.
UNSAFE_CHARACTERS = '\\/*?:"<>|\r\n\t\x00'
# Header and columns of the registry's CSV form.
CSV_COLUMNS = (
    "key", "document_id", "article_id", "section", "filename", "file_path", "file_size_bytes",
    "article_title", "article_url", "download_url", "status", "error", "timestamp",
)
# HTTP statuses and methods that are tried again.
RETRY_STATUSES = (429, 500, 502, 503, 504)
RETRY_METHODS = ("HEAD", "GET", "OPTIONS")
# Texts that stand in results where a page or a response gives none.
UNNAMED = "unnamed_document"
EMBEDDED = "Embedded Document"
HTML_ERROR = "Server returned HTML error page instead of PDF"
UNKNOWN_ERROR = "Unknown error"
EXISTS_REASON = "already_exists"
