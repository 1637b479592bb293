"""Value conversions as column expressions over whole tables."""
