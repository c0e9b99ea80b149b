"""Lists, limits and codes that results depend on."""

# ---------------------------------------------------------------------------
# Limits and defaults
# ---------------------------------------------------------------------------
DEFAULT_MAX_TOKENS = 100
DEFAULT_OVERLAP_TOKENS = 20
MODEL_MAX_TOKENS = 8191
MIN_CHUNK_SIZE = 212
MAX_CHUNK_SIZE = 8191
MAX_FILE_SIZE = 1024 * 1024
POSTS_PER_PAGE = 100
MAX_PAGES = 1000
DEFAULT_CONCURRENCY = 5
KEPT_DOWNLOADS = 3
FRENCH_THRESHOLD = 3
DEFAULT_TOKENIZER = "cl100k_base"
TOKENIZERS = ["cl100k_base", "p50k_base", "r50k_base"]

# ---------------------------------------------------------------------------
# Substrings whose presence speaks for French ("des " counts twice)
# ---------------------------------------------------------------------------
FRENCH_INDICATORS = [
    "le ", "la ", "les ", "un ", "une ", "des ",
    "et ", "ou ", "mais ", "donc ", "car ", "ni ",
    "que ", "qui ", "quoi ", "dont ", "où ",
    "avec ", "sans ", "pour ", "par ", "sur ",
    "dans ", "de ", "du ", "des ", "au ", "aux ",
]

# ---------------------------------------------------------------------------
# Repository files
# ---------------------------------------------------------------------------
REPOSITORY_HOSTS = ["github.com", "api.github.com"]
DEFAULT_REF = "main"
SHA_HEADER = "X-GitHub-SHA"

IMPORTABLE_EXTENSIONS = [
    ".md", ".txt", ".rst", ".py", ".js", ".go", ".java", ".cpp", ".c", ".h", ".hpp",
    ".css", ".html", ".xml", ".json", ".yaml", ".yml", ".toml", ".ini", ".cfg", ".conf",
]

EXCLUDED_SUBSTRINGS = [
    ".git", "node_modules", ".next", ".nuxt", "dist", "build", ".vscode", ".idea",
    "__pycache__", ".pytest_cache", ".coverage", ".DS_Store",
]

HTML_EXTENSIONS = [".html", ".htm"]

FENCED_EXTENSIONS = [
    ".txt", ".py", ".js", ".go", ".java", ".cpp", ".c", ".h", ".hpp", ".css",
    ".json", ".yaml", ".yml", ".toml", ".ini", ".cfg", ".conf",
]

LANGUAGE_BY_EXTENSION = {
    ".py": "python",
    ".js": "javascript",
    ".ts": "typescript",
    ".go": "go",
    ".java": "java",
    ".cpp": "cpp",
    ".c": "c",
    ".h": "c",
    ".hpp": "cpp",
    ".css": "css",
    ".html": "html",
    ".htm": "html",
    ".xml": "xml",
    ".json": "json",
    ".yaml": "yaml",
    ".yml": "yaml",
    ".toml": "toml",
    ".ini": "ini",
    ".cfg": "ini",
    ".conf": "ini",
    ".sh": "bash",
    ".bash": "bash",
    ".zsh": "zsh",
    ".fish": "fish",
    ".ps1": "powershell",
    ".sql": "sql",
    ".r": "r",
    ".rb": "ruby",
    ".php": "php",
    ".swift": "swift",
    ".kt": "kotlin",
    ".scala": "scala",
    ".rs": "rust",
    ".dart": "dart",
    ".lua": "lua",
    ".pl": "perl",
}

STORED_CODE_LANGUAGES = ["python", "sql", "javascript"]
STORED_NATURAL_LANGUAGES = ["en", "fr"]
STORED_FORMATS = ["json", "yml", "yaml", "md"]

# ---------------------------------------------------------------------------
# posts
# ---------------------------------------------------------------------------
POST_PATH_MARK = "/wp-json/"
POST_REQUIRED_KEYS = ["content", "title", "date_gmt", "modified_gmt"]

# ---------------------------------------------------------------------------
# Embedding models (name, dimension, largest input in tokens)
# ---------------------------------------------------------------------------
EMBEDDING_MODELS = [
    ("text-embedding-3-small", 1536, 8191),
    ("text-embedding-3-large", 3072, 8191),
    ("text-embedding-ada-002", 1536, 8191),
    ("togethercomputer/m2-bert-80M-8k-retrieval", 768, 8192),
    ("togethercomputer/m2-bert-80M-32k-retrieval", 768, 32768),
]
EMBEDDING_COLUMNS = {768: "embedding_768", 1536: "embedding_1536", 3072: "embedding_3072"}
