"""The control plane: configuration, commits, checkpoints. Plain Python; nothing here needs a JVM."""
