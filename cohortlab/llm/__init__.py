"""Training-data operators: filtering, deduplication, scoring, extraction and
mixing of document collections.  Nothing else in the library imports this
subpackage."""
