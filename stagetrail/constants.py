"""Fixed values of the lifecycle domain.

Everything below is data that has to be equal for results to be equal: closed
lists, key orders, size limits and text patterns. Patterns are written once in
the portable form with ``\\b \\w \\d \\s``; ``functions.text.java_regex`` gives those
tokens their Unicode meaning.
"""

from __future__ import annotations

# -- fixed values: event table -------------------------------------------------
EVENT_TYPES = ("found", "draft_created", "applied", "reply", "interview", "reject", "offer", "withdrawn", "closed")
OUTCOME_TYPES = ("interview", "reject", "offer", "withdrawn")
APPLIED_STATUSES = ("submitted", "sent", "email_sent", "form_submitted")
FOUND_TS_COLUMNS = ("created_at_utc", "found_at_utc", "added_at_utc")
APPLIED_TS_COLUMNS = ("sent_at_utc", "form_submitted_at_utc", "email_sent_at_utc")
CV_COLUMNS = ("cv_basename", "cv_pdf", "cv_docx", "cv_path")
CV_PATTERN = r"^cv-\d{8}-[a-z_]+$"
PAYLOAD_TEXTS = ("company", "title", "location", "application_type", "origin")
IMAGE_SOURCE_TYPES = ("image", "image/png", "image/jpeg", "image/webp")
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# -- fixed values: keywords and titles -----------------------------------------
KEYWORD_TOKEN = r"[a-zA-Z+#.]{2,}"
KEYWORD_VOCABULARY = (
    "sql", "python", "ml", "nlp", "rag", "bi", "looker", "bigquery", "gcp", "aws", "spark", "excel",
    "tableau", "pandas", "dbt", "etl", "kafka", "docker", "kubernetes", "terraform", "java", "scala",
    "react", "typescript",
)
TITLE_FAMILIES = (
    "data_analyst",
    "bi_analyst",
    "data_scientist",
    "ml_engineer",
    "data_engineer",
    "software_engineer",
    "research",
    "other",
)
TITLE_RULES = (
    ("ml_engineer", r"\b(ml|mlops|llm|ai|machine learning)\b.{0,10}\bengineer\b|\bmlops\b|\bmle\b|מהנדס/?ת? (למידת מכונה|ml)"),
    ("data_engineer", r"\bdata engineer\b|\betl\b|\bdata pipeline|מהנדס/?ת? (ה)?נתונים"),
    ("data_scientist", r"\bdata scien(tist|ce)\b|מדע(ן|נית) נתונים"),
    ("bi_analyst", r"\bbi\b|\bbusiness intelligence\b|\blooker\b|\btableau\b|\bpower bi\b"),
    ("data_analyst", r"\banalyst\b|\banalytics\b|אנליסט"),
    ("research", r"\bresearch(er)?\b|חוקר|מחקר"),
    ("software_engineer", r"\bsoftware engineer\b|\bdeveloper\b|\bbackend\b|\bfrontend\b|\bfull ?stack\b|מפתח|מתכנת"),
)

# Every match of a title rule contains one of its words; checked before the rule itself.
TITLE_WORDS = {
    "ml_engineer": ("engineer", "mlops", "mle", "מהנדס"),
    "data_engineer": ("data engineer", "etl", "data pipeline", "מהנדס"),
    "data_scientist": ("data scien", "מדע"),
    "bi_analyst": ("bi", "business intelligence", "looker", "tableau"),
    "data_analyst": ("analyst", "analytics", "אנליסט"),
    "research": ("research", "חוקר", "מחקר"),
    "software_engineer": ("software engineer", "developer", "backend", "frontend", "full", "מפתח", "מתכנת"),
}

# -- fixed values: statistics and data quality ----------------------------------
WILSON_Z = 1.96
MIN_GROUP_SIZE = 30
DQ_WINDOW_DAYS = 7
DQ_NULL_RATE_LIMIT = 0.5
DQ_FRESHNESS_HOURS = 48
HEARTBEAT_SECONDS = 180
LOAD_CHUNK_ROWS = 5000

# -- fixed values: untrusted text ------------------------------------------------
SCAN_MAX_CHARS = 4000
LOG_MAX_CHARS = 120
INVISIBLE_CHARS = "\\u200b-\\u200d\\u2060\\ufeff\\u202a-\\u202e\\u2066-\\u2069\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f"
SCAN_RULES = (
    ("instruction_override", r"(?i)(ignore (all )?(previous|prior|above) (instructions|rules)|disregard (your )?(rules|policy)|jailbreak|\bDAN\b|developer mode|system prompt)"),
    ("instruction_override_he", r"(התעלם|תתעלם|שכח|תשכח)\s+(מכל\s+)?(ה)?(הוראות|כללים|ההנחיות)"),
    ("role_hijack", r"(?i)(you are now|new (system )?persona|pretend you have no (rules|limits)|act as (root|admin))"),
    ("tool_coercion", r"(?i)(system\.run|shell\s*=\s*true|docker\.sock|/bin/sh|subprocess|os\.system|curl\s+-)"),
    ("path_exfil", r"(?i)(\.env\b)"),
    ("encoding_smuggle", r"(?i)(base64.{0,20}ignore|<script|\\x00)"),
    ("send_action", r"(?i)(send (this|the) (cv|email|application)|submit (the )?application|שלח (את )?(הקורות|המייל|המועמדות))"),
)
# Every match of a rule contains one of its words (whole, where so marked); checked before the rule itself.
SCAN_WORDS = {
    "instruction_override": ("ignore ", "disregard ", "jailbreak", r"\bdan\b", "developer mode", "system prompt"),
    "instruction_override_he": ("תעלם", "שכח"),
    "role_hijack": ("you are now", "persona", "pretend you have no ", "act as "),
    "tool_coercion": ("system.run", "shell", "docker.sock", "/bin/sh", "subprocess", "os.system", "curl"),
    "path_exfil": (".env",),
    "encoding_smuggle": ("base64", "<script", "\\x00"),
    "send_action": ("send th", "submit ", "שלח "),
}
PII_RULES = (
    ("email", r"[\w.+-]+@[\w-]+\.[\w.-]+"),
    ("il_id", r"(?<!\d)\d{9}(?!\d)"),
    ("phone", r"(?<!\d)(?:\+972[-\s]?|0)(?:[23489]|5\d)[-\s]?\d{3}[-\s]?\d{4}(?!\d)"),
    ("card", r"(?<!\d)(?:\d[ -]?){13,19}(?!\d)"),
)
BLOCK_MARKER = r"(?i)-{3,}\s*(BEGIN|END)\s+OCR\s+TEXT\s*-{3,}"
BLOCK_MARKER_REPLACEMENT = "[marker removed]"
HTTPS_URL = r"(?i)https://[^\s<>\"']+"
URL_TAIL = ").,;]"

# -- fixed values: task message v1 -------------------------------------------------
TASK_SCHEMA = "v1"
LINK_TASK = "telegram_job_link"
FILE_TASKS = ("drive_file", "ocr_job_image")
TASK_TYPES = (LINK_TASK, *FILE_TASKS)
TASK_SOURCES = ("telegram", "drive")
LINK_SOURCE = "telegram"
TASK_KEYS = ("schema", "task_id", "type", "source", "payload", "dedupe_key", "created_at")
TASK_PAYLOAD_REQUIRED = ("url", "file_id", "version", "text")
TASK_PAYLOAD_KEYS = ("url", "file_id", "version", "text", "sha256", "mime")
TASK_MIMES = ("image/png", "image/jpeg", "image/webp", "application/pdf", "text/plain")
TASK_ID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
SHA256_PATTERN = r"^[0-9a-f]{64}$"
TASK_URL_PATTERN = r"^https://"
TASK_MAX_LENGTHS = {"url": 2000, "file_id": 300, "version": 64, "text": 4000}
CREATED_AT_MAX = 40
TRANSIENT_CODES = (408, 429)
TRANSIENT_ERROR = "bus_dir_unset"
MAX_ATTEMPTS = 5
RETENTION_DAYS = 7
RETRY_SECONDS = (10, 600)

# -- fixed values: inbox files ---------------------------------------------------
MIME_BY_SUFFIX = {
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".webp": "image/webp",
    ".pdf": "application/pdf",
    ".txt": "text/plain",
}
SKIP_FOLDERS = ("_failed", "_done")
FILE_VERSION_CHARS = 16

# -- fixed values: extraction records -----------------------------------------------
RECORD_FIELDS = ("title", "company", "requirements", "location", "contact")
RECORD_LANGUAGES = ("he", "en", "mixed")
CONTACT_WHOLE = (
    r"(?i)^[\w.+-]+@[\w-]+\.[\w.-]+$",
    r"^(?:\+?\d{1,3}[-\s]?)?(?:\(?\d{2,4}\)?[-\s]?)?\d{3}[-\s]?\d{4,6}$",
    r"(?i)^https?://[^\s/$.?#].[^\s]*$",
)
CONTACT_SEARCH = (
    r"[\w.+-]+@[\w-]+\.[\w.-]+",
    r"(?i)https?://\S+",
    r"(?:\+?\d{1,3}[-\s]?)?\(?\d{2,4}\)?[-\s]?\d{3}[-\s]?\d{4,6}",
)
CONTACT_TAIL = ".,;)"
REPLY_FENCE = r"(?i)```(?:json)?\s*([\s\S]*?)```"
REVIEW_CONFIDENCE = 0.7
IMAGE_JOB_PREFIX = "img-"
IMAGE_ORIGIN = "image_ad"

# -- fixed values: scoring --------------------------------------------------------------
FINAL_LETTERS = ("ךםןףץ", "כמנפצ")
SCORE_PUNCTUATION = r"[^\w\s@.+]|_"
REQUIREMENTS_F1 = 0.6
ADOPT_ACCURACY = 0.90
ADOPT_WILSON_LOW = 0.80
