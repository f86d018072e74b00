"""Writers, publication and output digests."""

from docquarry.sinks.bson import encode_bson
from docquarry.sinks.digest import output_digest, part_digests
from docquarry.sinks.publish import OutputExists, staged_output
from docquarry.sinks.writers import encode, write

__all__ = ["OutputExists", "encode", "encode_bson", "output_digest", "part_digests", "staged_output", "write"]
