from .checkpoints import checkpoint_report, score_checkpoints
from .manifests import clean_manifest, manifest_reason
from .sanity import sanity_check
from .training import prepare_training
