"""Bronze readers, per-source specifications and the shared extraction job."""
