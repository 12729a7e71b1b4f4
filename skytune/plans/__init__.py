"""The models: staging, music mood, weather mood, mart, listening metrics, training."""
