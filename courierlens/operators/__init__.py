"""DataFrame -> DataFrame building blocks shared by every report and model."""
