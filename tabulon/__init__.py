"""tabulon: a Spark-native file-to-table ELT library.

Reads directories of delimited extracts (plain or zipped), checks them against a
declared schema, parses mixed date formats leniently, runs data-quality gates,
resolves duplicate keys and upserts many ordered files into one keyed, versioned
table.  Everything is expressed as DataFrame plans so Catalyst and AQE choose the
physical strategy.
"""

from tabulon.session import build_session, checkpoint_root, scratch_path, stage

__all__ = ["build_session", "checkpoint_root", "scratch_path", "stage"]
