"""DataFrame operators: segmentation, batching, quality measures, annotations, detection."""
