from podium.functions.codec import decode_json, encode_json, unwrap_json
from podium.functions.text import normalized

__all__ = ["decode_json", "encode_json", "normalized", "unwrap_json"]
