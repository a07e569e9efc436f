"""Declared tables and landed-file shapes.

Column names, order and types are fixed values: they must equal those of the
warehouse that jobs and queries already use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

FEED_ENTRY = """
    id string, link string, title string, summary string, published string,
    tags array<struct<term:string, scheme:string, label:string>>,
    content array<struct<type:string, language:string, base:string, value:string>>
"""

# <item> of an RSS 2.0 document.
FEED_ITEM = """
    guid string, link string, title string, description string, pubDate string,
    category array<string>, `content:encoded` string
"""

NOW = "localtimestamp()"


@dataclass(frozen=True, eq=False)
class Table:
    """A declared table: columns as DDL, its key, and column defaults."""

    layer: str
    name: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c}` {t}" for c, t in self.columns.items())


POSTS = Table("stage", "posts", {
    "id": "string", "link": "string", "title": "string", "summary": "string",
    "content_source": "string", "content_text": "string", "job_id": "string",
    "published": "timestamp_ntz", "ingest_timestamp": "timestamp_ntz",
}, key=("id",))

TAGS = Table("stage", "tags", {
    "term": "string", "post_id": "string", "job_id": "string",
    "ingest_timestamp": "timestamp_ntz",
}, key=("term", "post_id"))

LINKS = Table("stage", "links", {
    "post_id": "string", "index": "int", "href": "string", "title": "string",
    "ingest_timestamp": "timestamp_ntz", "job_id": "string",
}, key=("post_id", "index", "href"))

IMAGES = Table("stage", "images", {
    "post_id": "string", "index": "int", "src": "string", "width": "int", "height": "int",
    "ingest_timestamp": "timestamp_ntz", "job_id": "string",
}, key=("post_id", "index", "src"))

AUTHORS = Table("stage", "authors", {
    "post_id": "string", "index": "int", "name": "string", "image": "string", "bio": "string",
    "ingest_timestamp": "timestamp_ntz", "job_id": "string",
}, key=("post_id", "index", "name"))

MODEL_RUNS = Table("mlops", "model_runs", {
    "job_id": "string", "name": "string", "gcs_path": "string", "model_path": "string",
    "created_at": "timestamp_ntz",
}, key=("job_id",), defaults={"created_at": NOW})

JOB_METRICS = Table("mlops", "job_metrics", {
    "job_id": "string", "metric_name": "string", "metric_value": "float",
    "created_at": "timestamp_ntz",
}, defaults={"created_at": NOW})

JOB_PARAMETERS = Table("mlops", "job_parameters", {
    "job_id": "string", "parameter_name": "string", "parameter_value": "string",
    "created_at": "timestamp_ntz",
}, defaults={"created_at": NOW})

PREDICTIONS = Table("ml", "postlength_predictions", {
    "id": "string", "length_pred": "float", "job_id": "string", "created_at": "timestamp_ntz",
}, defaults={"created_at": NOW})

# Ledger of posts already turned into vectors.
EMBEDDED_POSTS = Table("genai", "embedded_posts", {
    "id": "string", "parsed_timestamp": "timestamp_ntz",
}, key=("id",), defaults={"parsed_timestamp": NOW})

# Entries kept as one flat table with the raw entry beside the fields.
FLAT_POSTS = Table("feeds", "post", {
    "id": "string", "url": "string", "title": "string", "published_date": "timestamp",
    "content": "string", "summary": "string", "ingest_timestamp": "timestamp",
    "job_id": "string", "raw_feed": "string",
}, key=("id",))

# Rows of every step of a load.
LOAD_COUNTS = Table("stage", "load_counts", {"job_id": "string", "step": "string", "rows": "bigint"})

# Sample table.
USERS = Table("sandbox", "users", {
    "user_id": "int", "username": "string", "email": "string", "created_at": "timestamp_ntz",
}, key=("user_id",))

STAGE_TABLES = (POSTS, TAGS, LINKS, IMAGES, AUTHORS)
ALL_TABLES = STAGE_TABLES + (
    MODEL_RUNS, JOB_METRICS, JOB_PARAMETERS, PREDICTIONS, EMBEDDED_POSTS, FLAT_POSTS, LOAD_COUNTS, USERS,
)

CHUNK_RECORD = """
    id string, values array<float>,
    metadata struct<link:string, title:string, published_timestamp:bigint,
                    chunk_index:int, post_id:string, chunk_text:string>
"""

