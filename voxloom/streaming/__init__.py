from .first_wins import first_arrivals, start_batches
from .manifest_stream import read_manifest_stream, start_manifest_filter
