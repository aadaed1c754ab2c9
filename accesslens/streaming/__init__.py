from accesslens.streaming.file_batches import stream_file_batches

__all__ = ["stream_file_batches"]
