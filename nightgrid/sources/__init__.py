"""Reading raw exports, snapshots and edited templates; writing results."""
