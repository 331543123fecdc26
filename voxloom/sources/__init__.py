from .keyed_files import write_keyed, write_subtitle_files
from .lines import (
    clean_lines,
    manifest_from_csv,
    parse_sanity_lines,
    parse_subtitles,
    sanity_manifest,
    urls_from_ids,
)
from .manifest import file_order, list_files, number_rows, preflight, read_manifest, read_splits, read_tsv
from .sinks import (
    append_step_scores,
    write_averages,
    write_manifest,
    write_sanity_report,
    write_score_report,
    write_shards,
    write_splits,
    write_subtitles,
)
from .textgrid import manifest_from_textgrid, read_textgrids
from .wav import probe_wav, read_wavs
from .wav_ranges import cut_ranges, probe_ranges, wav_listing
