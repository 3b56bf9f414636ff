"""Geographic text and place analytics on PySpark."""

from placetally.plans.jobs import extract_pois, metro_words, poi_nearby, state_county_words, write_pois
from placetally.session import build_session
from placetally.sources.boundaries import read_features
from placetally.sources.records import read_mixed, read_nodes, read_pois, read_posts, read_stopwords
from placetally.sources.sinks import write_results, write_tsv
from placetally.streaming.flows import ingest_archived, stream_statuses, stream_to_log

__all__ = [
    "build_session",
    "extract_pois",
    "ingest_archived",
    "metro_words",
    "poi_nearby",
    "read_features",
    "read_mixed",
    "read_nodes",
    "read_pois",
    "read_posts",
    "read_stopwords",
    "state_county_words",
    "stream_statuses",
    "stream_to_log",
    "write_pois",
    "write_results",
    "write_tsv",
]
